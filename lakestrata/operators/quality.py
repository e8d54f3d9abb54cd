"""Data-quality rules: observed expectations, keys, references, domains, shares, schema census."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.joins import orphan_keys

REPORT = "rule string, met long, unmet long, unknown long"


class ExpectationError(ValueError):
    """Rows failed a rule that allows no failures."""


# --- predicates ------------------------------------------------------------------------------


def contains_word(column: str, words: Sequence[str]) -> Column:
    """The text contains one of the words, whole and in any case."""
    quoted = "|".join(_quote(w) for w in words)
    return F.col(column).rlike(rf"(?i)\b({quoted})\b")


def _quote(word: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+-?^$|/&" else c for c in word)


def has_format(column: str, pattern: str) -> Column:
    """The whole text matches the regular expression."""
    return F.col(column).rlike(rf"^(?:{pattern})$")


# --- expectations ----------------------------------------------------------------------------


def _counts(rules: Mapping[str, str]) -> list[Column]:
    columns = [F.count(F.lit(1)).alias("rows")]
    for i, predicate in enumerate(rules.values()):
        columns.append(F.count_if(F.expr(predicate)).alias(f"met{i}"))
        columns.append(F.count_if(F.expr(f"({predicate}) IS NULL")).alias(f"unknown{i}"))
    return columns


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Per rule the rows that meet it, the rows that do not, and how many of those were NULL.

    One scan and one row of counters for all rules.
    """
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"met{i}").alias("met"),
            (F.col("rows") - F.col(f"met{i}")).alias("unmet"),
            F.col(f"unknown{i}").alias("unknown"),
        )
        for i, name in enumerate(rules)
    ]
    return df.agg(*_counts(rules)).select(F.inline(F.array(*rows)))


def observe_rules(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, counting the rules during whatever action runs on it."""
    observation = Observation()
    return df.observe(observation, *_counts(rules)), observation


def observed_report(spark: SparkSession, observation: Observation, rules: Mapping[str, str]) -> DataFrame:
    """The report of an observation; only to be read after its action succeeded."""
    return spark.createDataFrame([(name, *counts) for name, counts in observed_counts(observation, rules).items()], REPORT)


def observed_counts(observation: Observation, rules: Mapping[str, str]) -> dict[str, list[int]]:
    """Met, unmet and unknown rows by rule; only to be read after the action succeeded."""
    seen = observation.get
    return {name: [seen[f"met{i}"], seen["rows"] - seen[f"met{i}"], seen[f"unknown{i}"]] for i, name in enumerate(rules)}


def drop_unmet(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The rows that meet every rule; NULL does not meet one."""
    for predicate in rules.values():
        df = df.filter(F.expr(predicate))
    return df


def fail_unmet(report: DataFrame) -> None:
    """Raise when a rule of the report has unmet rows."""
    failed = report.filter("unmet > 0").orderBy("rule").collect()
    if failed:
        raise ExpectationError("; ".join(f"{r['rule']}: {r['unmet']} rows" for r in failed))


# --- whole-table checks ----------------------------------------------------------------------


def key_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys, positive keys, and whether the key is unique and positive."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
        F.count_if(F.col(key) > 0).alias("positive_keys"),
    ).select(
        "*",
        (F.col("distinct_keys") == F.col("rows")).alias("is_unique"),
        (F.col("positive_keys") == F.col("rows")).alias("is_positive"),
    )


def reference_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphan key values and orphan rows of the child."""
    return orphan_keys(child, parent, child_key, parent_key).agg(
        F.count(F.lit(1)).alias("orphan_keys"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows"),
    )


def one_to_one_check(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Row counts, repeated keys and unmatched keys of both sides; all zero apart from equal counts is 1:1.

    Both sides are counted per key in one aggregation, so a single shuffle answers everything. NULL
    keys match nothing: their rows are counted per side and enter no other number.
    """
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    a = left.select(F.col(left_key).alias("k"), one.alias("a"), none.alias("b"))
    b = right.select(F.col(right_key).alias("k"), none.alias("a"), one.alias("b"))
    both = a.unionByName(b).groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    known = F.col("k").isNotNull()
    of = lambda count: F.coalesce(F.sum(F.when(known, F.col(count))), F.lit(0))
    absent = lambda count: F.coalesce(F.sum(F.when(~known, F.col(count))), F.lit(0))
    return both.agg(
        absent("a").alias("left_null_keys"),
        absent("b").alias("right_null_keys"),
        of("a").alias("left_rows"),
        of("b").alias("right_rows"),
        F.count_if(known & ((F.col("a") > 1) | (F.col("b") > 1))).alias("repeated_keys"),
        F.count_if(known & (F.col("b") == 0)).alias("left_only_keys"),
        F.count_if(known & (F.col("a") == 0)).alias("right_only_keys"),
    )


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Per check the rows that are not known to pass it; one scan for all."""
    counted = df.agg(
        *(F.count_if(~F.coalesce(check, F.lit(False))).alias(f"c{i}") for i, check in enumerate(checks.values())),
        F.count(F.lit(1)).alias("rows"),
    )
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("violations"), (F.col(f"c{i}") == 0).alias("passed"))
        for i, name in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def schema_census(schema: T.StructType) -> dict[str, int]:
    """Columns per simple type name, and in total under ``columns``."""
    census = Counter(f.dataType.simpleString() for f in schema)
    return {"columns": len(schema), **dict(sorted(census.items()))}


def missing_columns(schema: T.StructType, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in schema.names]
