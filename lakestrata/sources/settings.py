"""The key/value settings table: tiny by contract, so it may reach the driver."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("key", "value")


def replace_settings(
    spark: SparkSession, table: str, pairs: Mapping[str, str], columns: tuple[str, str] = COLUMNS
) -> None:
    key, value = columns
    rows = spark.createDataFrame(list(pairs.items()), f"{key} string not null, {value} string not null")
    rows.coalesce(1).write.mode("overwrite").format("parquet").saveAsTable(table)


def missing_settings(old: DataFrame, new: DataFrame, columns: tuple[str, str] = COLUMNS) -> DataFrame:
    """One row per key of ``new`` absent from ``old``; of repeated keys the least value."""
    key, value = columns
    once = new.groupBy(key).agg(F.min(value).alias(value))
    return once.join(old, key, "left_anti").select(key, value)


def insert_missing(
    spark: SparkSession, table: str, new: DataFrame, columns: tuple[str, str] = COLUMNS
) -> None:
    """Append the keys of ``new`` the table does not hold; existing values never change."""
    rows = missing_settings(spark.table(table), new, columns)
    rows.write.mode("append").insertInto(table)


def load_settings(
    spark: SparkSession, table: str, required: tuple[str, ...] = (), columns: tuple[str, str] = COLUMNS
) -> dict[str, str]:
    """The settings as a dict; raises where a required key is missing.

    With ``required`` keys only those are read, so what reaches the driver is as large as the
    request. Without, it is the whole table.
    """
    rows = spark.table(table).select(*columns)
    if required:
        rows = rows.filter(F.col(columns[0]).isin(*required))
    found = {row[0]: row[1] for row in rows.collect()}
    absent = [key for key in required if key not in found]
    if absent:
        raise KeyError(f"settings missing in {table}: {', '.join(absent)}")
    return found


def lookup(df: DataFrame, key: str, columns: tuple[str, str] = COLUMNS) -> DataFrame:
    return df.filter(F.col(columns[0]) == key)


def split_codes(value: str, expected: int) -> list[str]:
    """A comma-separated code list whose meaning is positional."""
    codes = [code.strip() for code in value.split(",")]
    if len(codes) < expected or not all(codes[:expected]):
        raise ValueError(f"expected {expected} codes, got {value!r}")
    return codes[:expected]
