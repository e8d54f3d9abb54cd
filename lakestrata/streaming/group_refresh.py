"""Group-aggregate refresh: new rows become mergeable partials, readers add them up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakestrata.operators.aggregate import Metric, merge_typed, typed_metrics, typed_partials
from lakestrata.sources import fs
from lakestrata.sources.ingest import require_checkpoint, run_available
from lakestrata.sources.tables import numbered, publish

BATCH, FOLDED = "batch", "upto"


def group_refresh(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    type_column: str,
    value_column: str,
    scale: int | None = None,
    fold_after: int = 64,
) -> None:
    """Aggregate the new rows of ``stream`` into one published partial per micro-batch.

    Partials hold every type, so metrics over any types can be read at any time. Only groups that
    occur in a batch are touched. A replayed batch finds its partial there; a checkpoint that is
    new beside a target with batches raises.
    After ``fold_after`` partials they are folded into one, which bounds what a reader merges.
    """

    def add(batch: DataFrame, number: int) -> None:
        if _done(batch.sparkSession, target, number):
            return
        publish(typed_partials(batch, key, type_column, value_column, scale), target, f"{BATCH}={number}")

    require_checkpoint(stream.sparkSession, bool(_batches_or_folds(stream.sparkSession, target)), target, checkpoint)
    # a micro-batch arrives whole: columns must be cut before it, not inside
    run_available(stream.select(key, type_column, value_column), checkpoint, add)
    spark = stream.sparkSession
    if len(_open_batches(spark, target)) >= fold_after:
        fold(spark, target, key)


def read_metrics(spark: SparkSession, target: str, key: str, metrics: Sequence[Metric]) -> DataFrame:
    return typed_metrics(_partials(spark, target), key, metrics)


def fold(spark: SparkSession, target: str, key: str) -> None:
    """Fold all partials into one. What it was made from is removed only by the next fold."""
    batches = _open_batches(spark, target)
    if not batches:
        return
    stale = numbered(spark, target, FOLDED)
    publish(merge_typed(_partials(spark, target), key), target, f"{FOLDED}={batches[-1]}")
    for upto in stale[:-1]:
        fs.delete(spark, f"{target}/{FOLDED}={upto}")
    if stale:
        for number in numbered(spark, target, BATCH):
            if number <= stale[-1]:
                fs.delete(spark, f"{target}/{BATCH}={number}")


def _batches_or_folds(spark: SparkSession, target: str) -> list[int]:
    return numbered(spark, target, BATCH) + numbered(spark, target, FOLDED)


def _folded(spark: SparkSession, target: str) -> int:
    return max(numbered(spark, target, FOLDED), default=-1)


def _done(spark: SparkSession, target: str, number: int) -> bool:
    return number <= _folded(spark, target)


def _open_batches(spark: SparkSession, target: str) -> list[int]:
    folded = _folded(spark, target)
    return [n for n in numbered(spark, target, BATCH) if n > folded]


def _partials(spark: SparkSession, target: str) -> DataFrame:
    """The newest fold and every partial after it."""
    folded = _folded(spark, target)
    paths = [f"{target}/{FOLDED}={folded}"] if folded >= 0 else []
    paths += [f"{target}/{BATCH}={n}" for n in _open_batches(spark, target)]
    if not paths:
        raise FileNotFoundError(f"no partials below {target}")
    return spark.read.parquet(*(fs.escape_glob(p) for p in paths))
