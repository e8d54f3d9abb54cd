"""Projections: leading columns, tolerant drops, mapped renames, ingest stamps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lead_columns(df: DataFrame, lead: Sequence[str]) -> DataFrame:
    """The named columns first, the rest in their order; raises on a missing name."""
    missing = [name for name in lead if name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(*lead, *(c for c in df.columns if c not in set(lead)))


def drop_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the named columns; absent ones are no error."""
    return df.drop(*names)


def skipped_names(df: DataFrame, mapping: Mapping[str, str]) -> list[str]:
    """The mapped source columns ``df`` does not have."""
    return [source for source in mapping if source not in df.columns]


def rename_project(df: DataFrame, mapping: Mapping[str, str], strict: bool = False) -> DataFrame:
    """One select of the mapped columns under their new names, in mapping order.

    A source column that is absent is left out; with ``strict`` it is an error that names it.
    """
    skipped = skipped_names(df, mapping)
    if skipped and strict:
        raise ValueError(f"mapped columns missing from the input: {', '.join(skipped)}")
    return df.select(*(F.col(f"`{a}`").alias(b) for a, b in mapping.items() if a not in skipped))


def stamp_ingest(df: DataFrame, name: str = "ingest_ts") -> DataFrame:
    """With the current timestamp, one value for the whole query or micro-batch."""
    return df.withColumn(name, F.current_timestamp())
