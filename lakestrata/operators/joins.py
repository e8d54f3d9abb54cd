"""Equi-joins that keep the key once.

Hot keys are left to adaptive execution, which splits the many-row side of inner, left, semi and
anti joins at run time; nothing here counts rows or changes plan by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_once(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT JOIN; unmatched right columns are NULL, right-only rows are dropped."""
    return left.join(right, list(keys), "left")


def inner_once(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "inner")


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Per child key value without a parent: the key and its number of rows.

    The child is reduced to one row per key value before the anti join, so hot keys do no harm.
    NULL is no reference and therefore no orphan.
    """
    held = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(child_key)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias(child_key))
    return held.join(known, child_key, "left_anti")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """The child rows whose non-NULL key has no parent; NULL keys go before the shuffle."""
    named = child.filter(F.col(child_key).isNotNull())
    known = parent.select(F.col(parent_key).alias(child_key))
    return named.join(known, child_key, "left_anti")
