"""Full refresh that counts its expectations while it writes, and may drop rows or refuse on them."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.quality import drop_unmet, fail_unmet, observe_rules, observed_counts, observed_report
from lakestrata.sources import fs
from lakestrata.sources.tables import drop_versions, next_version, publish, show, stage

RULES_FILE = "_rules.json"

KEEP, DROP, FAIL = "keep", "drop", "fail"


def checked_refresh(
    df: DataFrame, root: str, rules: Mapping[str, str], unmet: str = KEEP, keep: int = 2
) -> DataFrame:
    """Publish ``df`` as the next version of ``root`` and return the report of ``rules``.

    The rules are counted on all rows of ``df`` in the same pass. ``unmet`` says what happens to
    rows that do not meet them: they are kept, dropped, or the version is not published and
    ExpectationError is raised.
    """
    if unmet not in (KEEP, DROP, FAIL):
        raise ValueError(f"unmet must be {KEEP}, {DROP} or {FAIL}, not {unmet!r}")
    spark = df.sparkSession
    watched, observation = observe_rules(df, rules)
    folder = next_version(spark, root)
    stage(drop_unmet(watched, rules) if unmet == DROP else watched, root, folder)
    report = observed_report(spark, observation, rules)
    if unmet == FAIL:
        fail_unmet(report)
    show(spark, root, folder)
    drop_versions(spark, root, keep)
    return report


def publish_checked(df: DataFrame, root: str, folder: str, rules: Mapping[str, str]) -> None:
    """``publish``, counting the rules of all rows in the pass that writes them.

    The counts lie in the folder before it is shown, so a folder that is there has them, and a
    repeated unit neither loses nor doubles any.
    """
    def write(rows: DataFrame, root: str, folder: str) -> None:
        watched, observation = observe_rules(rows, rules)
        stage(watched, root, folder)
        fs.write_text(rows.sparkSession, f"{root}/_staging/{folder}/{RULES_FILE}", json.dumps(observed_counts(observation, rules)))

    publish(df, root, folder, write if rules else stage)


def rule_counts(spark: SparkSession, root: str, folders: list[str]) -> dict[str, list[int]]:
    """Per rule the rows that met it, did not, and were unknown, over the named folders of one run."""
    total: dict[str, list[int]] = {}
    for folder in folders:
        if fs.exists(spark, f"{root}/{folder}/{RULES_FILE}"):
            for name, counts in json.loads(fs.read_text(spark, f"{root}/{folder}/{RULES_FILE}")).items():
                total[name] = [a + b for a, b in zip(total.get(name, [0, 0, 0]), counts)]
    return total
