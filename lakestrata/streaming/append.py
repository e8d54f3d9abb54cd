"""Append-only refresh: every new source row is transformed and appended once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.sources import fs
from lakestrata.sources.checked import publish_checked
from lakestrata.sources.ingest import require_checkpoint, run_available
from lakestrata.sources.tables import numbered

BATCH = "batch"


def append_refresh(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    sort_by: Sequence[str] = (),
    rules: Mapping[str, str] | None = None,
) -> None:
    """Append ``transform`` of the rows that are new in ``stream`` to the table ``target``.

    ``transform`` must work row by row. Spark itself rejects aggregates, sorts and windows here,
    which is what keeps the result equal to a full recompute. Every micro-batch is one published
    folder, so no list of all files ever written is kept, and is computed once: ``rules`` are counted
    while it is written, and ``sort_by`` sorts within its files, for readers to skip row groups. To
    gather equal values of all batches in few files use ``layout.recluster`` when enough has come.
    """
    if not stream.isStreaming:
        raise ValueError("append_refresh needs a streaming DataFrame")

    def add(batch: DataFrame, number: int) -> None:
        if sort_by:
            batch = batch.sortWithinPartitions(*sort_by)
        publish_checked(batch, target, f"{BATCH}={number}", rules or {})

    require_checkpoint(stream.sparkSession, bool(numbered(stream.sparkSession, target, BATCH)), target, checkpoint)
    run_available(transform(stream), checkpoint, add)


def read_appended(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows of the whole batches; empty while there are none."""
    whole = [fs.escape_glob(f"{target}/{BATCH}={n}") for n in numbered(spark, target, BATCH)]
    return spark.read.schema(schema).parquet(*whole) if whole else spark.createDataFrame([], schema)
