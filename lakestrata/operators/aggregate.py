"""Grouped metrics, frequencies, shares, reconciliation counts, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.functions.derive import or_zero


@dataclass(frozen=True)
class Metric:
    """``kind`` (count, sum or avg) of the values whose type equals ``code``."""

    name: str
    kind: str
    code: str

    def __post_init__(self) -> None:
        if self.kind not in ("count", "sum", "avg"):
            raise ValueError(f"metric kind must be count, sum or avg, not {self.kind!r}")


# --- conditional metrics: partials that add up, and the metrics made from them --------------
#
# A partial holds one count and one sum per code. Both merge by addition, so the same three
# steps serve a batch query, a streaming refresh, and the folding of many refreshes into one.


def partial_metrics(
    df: DataFrame, key: str, type_column: str, value_column: str, metrics: Sequence[Metric], scale: int | None = None
) -> DataFrame:
    """Per key and code the number and sum of non-NULL values; every key of ``df`` appears.

    ``scale`` sums as decimals with that many places: exact, and independent of row order.
    """
    value = F.col(value_column)
    amount = value.cast(f"decimal(18,{scale})") if scale is not None else value.cast("double")
    columns: list[Column] = []
    for code in _codes(metrics):
        chosen = F.when(F.col(type_column) == code, amount)
        columns += [F.count(chosen).alias(_count(code)), F.sum(chosen).alias(_sum(code))]
    return df.groupBy(key).agg(*columns)


def merge_partials(df: DataFrame, key: str) -> DataFrame:
    """Partials of the same key added up."""
    sums = []
    for field in df.schema:
        if field.name == key:
            continue
        total = F.sum(F.col(f"`{field.name}`"))
        if field.name.startswith("sum "):
            total = total.cast(field.dataType)
        sums.append(total.alias(field.name))
    return df.groupBy(key).agg(*sums)


def finish_metrics(df: DataFrame, key: str, metrics: Sequence[Metric]) -> DataFrame:
    """Metrics from merged partials; empty ones are 0 or 0.0."""
    return df.select(key, *(_finish(m).alias(m.name) for m in metrics))


def conditional_metrics(
    df: DataFrame, key: str, type_column: str, value_column: str, metrics: Sequence[Metric], scale: int | None = None
) -> DataFrame:
    """All metrics per key in one pass over ``df``."""
    return finish_metrics(partial_metrics(df, key, type_column, value_column, metrics, scale), key, metrics)


# The same partials one row per (key, type), of all types: what a refresh keeps, because any list of
# metrics, also a later one, can be read from them.


def typed_partials(df: DataFrame, key: str, type_column: str, value_column: str, scale: int | None = None) -> DataFrame:
    """``(key, type, n, total)``: number and sum of the non-NULL values per key and type."""
    value = F.col(value_column)
    amount = value.cast(f"decimal(18,{scale})") if scale is not None else value.cast("double")
    return df.groupBy(key, F.col(type_column).alias("type")).agg(F.count(amount).alias("n"), F.sum(amount).alias("total"))


def merge_typed(df: DataFrame, key: str) -> DataFrame:
    total = df.schema["total"].dataType
    return df.groupBy(key, "type").agg(F.sum("n").alias("n"), F.sum("total").cast(total).alias("total"))


def typed_metrics(df: DataFrame, key: str, metrics: Sequence[Metric]) -> DataFrame:
    """Metrics per key from typed partials, merged or not; every key of ``df`` appears."""
    columns: list[Column] = []
    for code in _codes(metrics):
        chosen = F.col("type") == code
        columns += [F.sum(F.when(chosen, F.col("n"))).alias(_count(code)), F.sum(F.when(chosen, F.col("total"))).alias(_sum(code))]
    return finish_metrics(df.groupBy(key).agg(*columns), key, metrics)


def _codes(metrics: Sequence[Metric]) -> list[str]:
    return list(dict.fromkeys(m.code for m in metrics))


def _count(code: str) -> str:
    return f"count {code}"


def _sum(code: str) -> str:
    return f"sum {code}"


def _finish(metric: Metric) -> Column:
    count, total = F.col(f"`{_count(metric.code)}`"), F.col(f"`{_sum(metric.code)}`").cast("double")
    if metric.kind == "count":
        return or_zero(count, 0)
    if metric.kind == "sum":
        return or_zero(total)
    return F.when(count > 0, total / count).otherwise(F.lit(0.0))


# --- whole-table numbers --------------------------------------------------------------------


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def next_key(df: DataFrame, key: str) -> DataFrame:
    """The greatest key and the one to continue from; an empty table continues from 1."""
    return df.agg(F.max(key).alias("max_key"), (F.coalesce(F.max(key), F.lit(0)) + 1).alias("next_key"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, equal counts by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.asc(column))


def class_shares(df: DataFrame, column: str, targets: Mapping[str, float], tolerance: float) -> DataFrame:
    """Per target class its percentage of all rows, and whether it lies within ``tolerance`` points.

    One scan and one row of counts for all classes; a class that does not occur has share 0.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *(F.count_if(F.col(column) == c).alias(f"n{i}") for i, c in enumerate(targets)),
    )
    rows = [
        F.struct(F.lit(c).alias("class"), F.col(f"n{i}").alias("rows"), F.lit(float(t)).alias("target"))
        for i, (c, t) in enumerate(targets.items())
    ]
    share = F.when(F.col("total") > 0, F.col("rows") * 100 / F.col("total")).otherwise(F.lit(0.0))
    return (
        counts.select("total", F.inline(F.array(*rows)))
        .withColumn("share", share)
        .select("class", "rows", "share", "target", (F.abs(share - F.col("target")) <= tolerance).alias("met"))
    )


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows, ordered by table name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")


def union_aligned(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name, in the column order of the first."""
    return reduce(DataFrame.unionByName, frames)


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` greatest rows by ``by``; ``tie_break`` decides equal values, ascending."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.orderBy(F.col(by).desc_nulls_last(), *(F.col(c).asc() for c in tie_break)).limit(k)
