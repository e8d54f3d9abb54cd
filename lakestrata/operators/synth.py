"""Seeded tables at scale: row generation, key draws, one-row-per-parent, snapshot mutation."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.draws import draw
from lakestrata.operators.index import dense_index, pick_condition, share_size


def generate_rows(spark: SparkSession, rows: int, name: str = "id", first: int = 1) -> DataFrame:
    """``rows`` consecutive ids from ``first``."""
    return spark.range(first, first + rows).withColumnRenamed("id", name)


def draw_parent(children: DataFrame, child_key: str, parents: DataFrame, parent_key: str, salt: str) -> DataFrame:
    """``children`` with a parent key drawn from the distinct keys of ``parents``.

    Draws are uniform over the parents, so the join keys carry no skew. Join before adding wide columns.
    """
    indexed = dense_index(parents.select(parent_key).distinct(), [parent_key], "_slot")
    size = indexed.agg(F.max("_slot")).collect()[0][0]
    if size is None:
        raise ValueError("parents has no rows to draw from")
    slots = children.withColumn("_slot", draw(salt, child_key) % F.lit(size + 1))
    return slots.join(indexed, "_slot").drop("_slot")


def one_per_parent(parents: DataFrame, parent_key: str, sequence: str = "seq") -> DataFrame:
    """The distinct parent keys, numbered 1..n in key order without gaps."""
    indexed = dense_index(parents.select(parent_key).distinct(), [parent_key], sequence)
    return indexed.withColumn(sequence, F.col(sequence) + 1)


def mutate_snapshot(
    df: DataFrame,
    key: str,
    share: float,
    rewrites: Sequence[Mapping[str, Column]],
    new_share: float,
    new_row: Callable[[Column], Mapping[str, Column]],
    salt: str,
) -> DataFrame:
    """The next snapshot: exactly ``int(n * share)`` rows rewritten, ``int(n * new_share)`` added.

    ``rewrites`` apply in order, later ones see the columns of earlier ones. New keys continue from
    the greatest key; ``new_row`` maps the key to the other columns. The chosen rows follow from
    (salt, key) alone. The old rows are scanned and rewritten in place, they are not shuffled.
    """
    spark = df.sparkSession
    top, rows = df.agg(F.max(key), F.count(F.lit(1))).collect()[0]
    picked = pick_condition(df, [key], share_size(rows, share), salt, rows)
    kept = df.withColumn("_picked", picked)
    for columns in rewrites:
        kept = kept.withColumns(
            {n: F.when(F.col("_picked"), c).otherwise(F.col(n)).cast(df.schema[n].dataType) for n, c in columns.items()}
        )
    fresh = generate_rows(spark, share_size(rows, new_share), key, (top or 0) + 1)
    made = {key: F.col(key), **new_row(F.col(key))}
    absent = [c for c in df.columns if c not in made]
    if absent:
        raise ValueError(f"new_row does not make {', '.join(absent)}")
    fresh = fresh.select(*(made[c].cast(df.schema[c].dataType).alias(c) for c in df.columns))
    return kept.drop("_picked").unionByName(fresh)


# --- argument checks -------------------------------------------------------------------------


def require_text(**values: str) -> None:
    for name, value in values.items():
        if not isinstance(value, str) or not value.strip():
            raise ValueError(f"{name} must not be empty")


def require_positive(**values: int) -> None:
    for name, value in values.items():
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ValueError(f"{name} must be a positive integer, not {value!r}")


def require_share(**values: float) -> None:
    for name, value in values.items():
        if not 0 < value <= 1:
            raise ValueError(f"{name} must be in (0, 1], not {value!r}")


def require_range(name: str, low: float, high: float) -> None:
    if not low < high:
        raise ValueError(f"{name}: {low!r} must be below {high!r}")


def require_date(**values: str) -> None:
    for name, value in values.items():
        if not isinstance(value, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value):
            raise ValueError(f"{name} must look like YYYY-MM-DD, not {value!r}")
        date.fromisoformat(value)
