"""Affected-key refresh by Spark's own state: a view of the newest left and right row per key.

Both sources run through one streaming aggregation whose state holds, per key, the newest row of
each. In update mode its output is the changed keys, already joined: nothing is looked up in stored
tables, listed or kept in memory between jobs. Every micro-batch appends its changed view rows as
one folder; of a key's rows the newest folder counts, and folders are folded now and then.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.latest import orderable
from lakestrata.sources import fs
from lakestrata.sources.checked import publish_checked
from lakestrata.sources.ingest import require_checkpoint
from lakestrata.sources.tables import numbered, publish, published

BATCH, FOLDED = "batch", "upto"
LEFT, RIGHT = "left", "right"


def stateful_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session for streams with state: kept in RocksDB, below the checkpoint, in ``partitions`` parts.

    The first run of a checkpoint fixes the number of parts; choose it for the keys to come.
    """
    if partitions < 1:
        raise ValueError("partitions must be at least 1")
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return own


def newest_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], newest_by: tuple[Sequence[str], Sequence[str]]) -> DataFrame:
    """Per key the newest ``left`` and ``right`` row, each as a struct of its other columns.

    Rows are ordered by their ``newest_by`` columns, then by the others, NULLs last: a total order up
    to equal rows, so neither batches nor partitions matter. A key with rows on one side only has
    NULL on the other. NULL keys are one group whose right side is NULL, as in a join. The same
    function serves batches and streams.
    """
    structs = [_row(side, keys, order) for side, order in zip((left, right), newest_by)]
    kinds = [side.select(row.alias("r")).schema["r"].dataType for side, row in zip((left, right), structs)]
    none = [F.lit(None).cast(kind) for kind in kinds]
    both = left.select(*keys, structs[0].alias(LEFT), none[1].alias(RIGHT)).unionByName(
        right.select(*keys, none[0].alias(LEFT), structs[1].alias(RIGHT))
    )
    named = reduce(and_, (F.col(k).isNotNull() for k in keys))
    pairs = both.groupBy(*keys).agg(F.max(LEFT).alias(LEFT), F.max(RIGHT).alias(RIGHT))
    return pairs.withColumn(RIGHT, F.when(named, F.col(RIGHT)))


def _row(side: DataFrame, keys: Sequence[str], newest_by: Sequence[str]):
    if not newest_by:
        raise ValueError("newest_by must name at least one column")
    rest = [f for f in side.schema if f.name not in {*keys, *newest_by}]
    unfit = [f.name for f in rest if not orderable(f.dataType)]
    if unfit:
        raise ValueError(f"columns that have no order can't be kept: {', '.join(unfit)}")
    return F.struct(*newest_by, *(F.col(f"`{f.name}`") for f in rest))


def view_refresh(
    left: DataFrame,
    right: DataFrame,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_by: tuple[Sequence[str], Sequence[str]],
    build: Callable[[DataFrame], DataFrame],
    view_keys: Sequence[str],
    rules: Mapping[str, str] | None = None,
    fold_after: int = 8,
) -> None:
    """Keep ``target`` equal to ``build`` of the newest left row of every key with its newest right row.

    ``left`` and ``right`` are streams of one session, best of ``stateful_session``; give their
    sources ``maxFilesPerTrigger``, so that a first load comes in bounded batches. ``build`` maps
    (keys, ``left`` struct, ``right`` struct or NULL) to view rows, one per key, row by row. A batch
    cut short is repeated from the state before it; one that is there is left alone.
    """
    if not (left.isStreaming and right.isStreaming):
        raise ValueError("view_refresh needs streaming DataFrames")
    spark = left.sparkSession
    pairs = newest_pairs(left, right, keys, newest_by)
    schema = build(spark.createDataFrame([], pairs.schema)).schema

    def add(batch: DataFrame, number: int) -> None:
        if number <= _folded(spark, target) or published(spark, target, f"{BATCH}={number}"):
            # there since a run that was cut short: only the state still has to take the batch
            batch.write.format("noop").mode("overwrite").save()
        else:
            publish_checked(build(batch.filter(F.col(LEFT).isNotNull())), target, f"{BATCH}={number}", rules or {})

    require_checkpoint(spark, bool(numbered(spark, target, BATCH) + numbered(spark, target, FOLDED)), target, checkpoint)
    query = (
        pairs.writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if len(_open_batches(spark, target)) >= fold_after:
        fold_view(spark, target, schema, view_keys)


def read_view(spark: SparkSession, target: str, schema: T.StructType, view_keys: Sequence[str]) -> DataFrame:
    """The view: of every key the row of its newest folder; empty while there is none.

    Folders since the last fold are small beside it: their newest rows replace those of the fold by
    an anti join, so the fold itself is shuffled only where they are too many to broadcast.
    """
    folded, batches = _folded(spark, target), _open_batches(spark, target)
    read = spark.read.schema(schema)
    base = read.parquet(fs.escape_glob(f"{target}/{FOLDED}={folded}")) if folded >= 0 else None
    if not batches:
        return spark.createDataFrame([], schema) if base is None else base
    paths = [fs.escape_glob(f"{target}/{BATCH}={n}") for n in batches]
    if len(paths) == 1:
        newer = read.parquet(*paths)
    else:
        tagged = spark.read.schema(T.StructType([*schema, T.StructField(BATCH, T.LongType())])).option("basePath", target).parquet(*paths)
        row = F.struct(*(F.col(f"`{c}`") for c in schema.names))
        newer = tagged.groupBy(*view_keys).agg(F.max_by(row, BATCH).alias("_row")).select("_row.*")
    if base is None:
        return newer
    gone = newer.select(*(F.col(k).alias(f"_{k}") for k in view_keys))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in view_keys))
    return base.join(gone, same, "left_anti").unionByName(newer)


def fold_view(spark: SparkSession, target: str, schema: T.StructType, view_keys: Sequence[str]) -> None:
    """Write the view as one folder. What it was made from is removed only by the next fold, so that
    readers who began before it finish undisturbed."""
    batches = _open_batches(spark, target)
    if not batches:
        return
    stale = numbered(spark, target, FOLDED)
    whole = read_view(spark, target, schema, view_keys).sortWithinPartitions(*view_keys)
    publish(whole, target, f"{FOLDED}={batches[-1]}")
    for upto in stale[:-1]:
        fs.delete(spark, f"{target}/{FOLDED}={upto}")
    if stale:
        for number in numbered(spark, target, BATCH):
            if number <= stale[-1]:
                fs.delete(spark, f"{target}/{BATCH}={number}")


def _folded(spark: SparkSession, target: str) -> int:
    return max(numbered(spark, target, FOLDED), default=-1)


def _open_batches(spark: SparkSession, target: str) -> list[int]:
    folded = _folded(spark, target)
    return [n for n in numbered(spark, target, BATCH) if n > folded]
