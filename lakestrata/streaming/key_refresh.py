"""Affected-key refresh: a latest-row-per-key table, and a view joined from two of them.

Such a table is split into buckets by a hash of the key. A micro-batch rewrites only the buckets
its keys fall into, as ``batch=<n>/bucket=<b>``. Readers take the newest copy of each bucket;
older copies stay until ``prune``, so no folder is replaced under a reader.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.latest import latest_per_key
from lakestrata.sources import fs
from lakestrata.sources.ingest import require_checkpoint, run_available
from lakestrata.sources.tables import numbered, published, show, subfolders

BATCH, BUCKET = "batch", "bucket"
_BUILT_FROM = "_built_from.json"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def key_refresh(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], newest_by: Sequence[str], buckets: int
) -> None:
    """Keep ``target`` equal to ``latest_per_key`` of all rows ``stream`` ever delivered.

    Choose ``buckets`` once per table, so that a bucket is a few files' worth of keys.
    """
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    schema = stream.schema

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if published(spark, target, f"{BATCH}={number}"):
            return
        # the batch is needed twice and Spark would read its files for each use
        batch.persist()
        try:
            # at most ``buckets`` small rows
            touched = [r[0] for r in batch.select(bucket_of(keys, buckets)).distinct().collect()]
            if not touched:
                return
            rows = read_keyed(spark, target, schema, touched).unionByName(batch)
            newest = latest_per_key(rows, keys, newest_by).withColumn(BUCKET, bucket_of(keys, buckets))
            _publish_buckets(newest, target, number, keys)
        finally:
            batch.unpersist()

    require_checkpoint(stream.sparkSession, bool(numbered(stream.sparkSession, target, BATCH)), target, checkpoint)
    run_available(stream, checkpoint, merge)


def join_refresh(
    spark: SparkSession,
    left: tuple[str, T.StructType],
    right: tuple[str, T.StructType],
    target: str,
    keys: Sequence[str],
    buckets: int,
    build: Callable[[DataFrame, DataFrame], DataFrame],
) -> list[int]:
    """Bring ``target`` up to date with two keyed tables; returns the buckets it rewrote.

    ``left`` and ``right`` are (folder, schema) of tables kept by ``key_refresh`` with the same
    ``keys`` and ``buckets``; ``build`` joins them on the keys. A bucket whose two inputs have not
    changed since it was built is not touched.
    """
    sources = [_newest_folders(spark, folder) for folder, _ in (left, right)]
    now = {b: [s.get(b, "").removeprefix(f) for s, (f, _) in zip(sources, (left, right))]
           for b in sorted(set(sources[0]) | set(sources[1]))}
    done = numbered(spark, target, BATCH)
    last = json.loads(fs.read_text(spark, f"{target}/{BATCH}={done[-1]}/{_BUILT_FROM}")) if done else {}
    changed = [b for b, state in now.items() if last.get(str(b)) != state]
    if not changed:
        return []
    built = build(read_keyed(spark, *left, changed), read_keyed(spark, *right, changed))
    number = done[-1] + 1 if done else 0
    _publish_buckets(built.withColumn(BUCKET, bucket_of(keys, buckets)), target, number, keys, json.dumps(now))
    return changed


def _publish_buckets(
    df: DataFrame, target: str, number: int, keys: Sequence[str], built_from: str | None = None
) -> None:
    spark = df.sparkSession
    staging = f"{target}/_staging/{BATCH}={number}"
    # rebalance gathers the rows of a bucket, and splits again what is too large for one file;
    # sorted files let a reader of few keys skip most row groups
    ordered = df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys)
    ordered.write.partitionBy(BUCKET).mode("overwrite").parquet(staging)
    if built_from is not None:
        fs.write_text(spark, f"{staging}/{_BUILT_FROM}", built_from)
    show(spark, target, f"{BATCH}={number}")


def _newest_folders(spark: SparkSession, target: str) -> dict[int, str]:
    """Bucket number to the folder of its newest copy."""
    newest: dict[int, str] = {}
    for number in numbered(spark, target, BATCH):
        folder = f"{target}/{BATCH}={number}"
        for bucket in subfolders(spark, folder, BUCKET):
            newest[bucket] = f"{folder}/{BUCKET}={bucket}"
    return newest


def read_keyed(
    spark: SparkSession, target: str, schema: T.StructType, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The table, or only some of its buckets; empty while nothing was written."""
    wanted = None if buckets is None else set(buckets)
    folders = [path for b, path in _newest_folders(spark, target).items() if wanted is None or b in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(fs.escape_glob(p) for p in folders))


def prune(spark: SparkSession, target: str) -> None:
    """Remove copies of buckets that a newer batch replaced."""
    current = set(_newest_folders(spark, target).values())
    for number in numbered(spark, target, BATCH)[:-1]:
        folder = f"{target}/{BATCH}={number}"
        old = [f"{folder}/{BUCKET}={b}" for b in subfolders(spark, folder, BUCKET)]
        if not current.intersection(old):
            fs.delete(spark, folder)
            continue
        for path in old:
            if path not in current:
                fs.delete(spark, path)
