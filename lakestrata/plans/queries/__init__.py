"""Every operator as a query over the test tables, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
Registered = dict[str, tuple[Query, str | None]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registered() -> Registered:
    from lakestrata.plans.queries import bank, quality, relational, sources, streams, synth

    found: Registered = {}
    for module in (relational, sources, streams, quality, synth, bank):
        found.update(module.QUERIES)
    return found
