"""Integer vectors, and a grid that brings every query together with every vector, block by block."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.session import new_scratch

SCALE = 256
MOST_SQUARES = 2.0**60
#: a block of the grid holds so many bytes of values at most, and is not cut below so many rows for the sake of more tasks
BLOCK_BYTES = 32 << 20
LEAST_ROWS = 512


def integers(vector: str, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component."""
    return F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))


def usable(vector: str, scale: int = SCALE) -> Column:
    """Whether a vector takes part: not NULL, no component NULL or not finite, and the squares of
    its integers sum to less than 2**60, so that inner products and squared distances are longs."""
    known = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    squares = F.aggregate(integers(vector, scale), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.coalesce(known & (squares < MOST_SQUARES), F.lit(False))


def stored_vectors(rows: DataFrame, vector: str, columns: Mapping[str, Column], keep: Column, scale: int = SCALE) -> DataFrame:
    """``(row, *columns, values)`` of the usable rows with ``keep``, written to the scratch folder.

    ``row`` tells rows apart that agree in everything else; being written, it is the same for all
    who read it. Other columns of ``rows`` don't travel, whatever their names.
    """
    held = rows.filter(usable(vector, scale) & keep).select(
        F.monotonically_increasing_id().alias("row"),
        *(c.alias(name) for name, c in columns.items()),
        integers(vector, scale).cast("array<int>").alias("values"),
    )
    path = new_scratch(rows.sparkSession, "vectors")
    held.write.parquet(path)
    return rows.sparkSession.read.schema(held.schema).parquet(path)


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers; missing last components are 0."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = np.asarray(lists.flatten()).astype(np.int64)
    sizes = np.asarray(pc.list_value_length(lists)).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    out[of, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def exact_type(*largest: float) -> type:
    """float64 where sums of products stay whole numbers in it, else int64. ``largest`` are bounds of
    vector lengths: by Cauchy and Schwarz no partial sum passes the product of two of them."""
    return np.float64 if max(largest, default=0.0) ** 2 < 2.0**51 else np.int64


def in_key_order(table: pa.Table, key: str) -> pa.Table:
    """Rows by key, NULL keys last, then by ``row``: of equal scores the first row counts."""
    return table.sort_by([(key, "ascending"), ("row", "ascending")])


def blocks_of(rows: int, width: int, wanted: int) -> int:
    """How many blocks: enough for their bytes, and ``wanted`` where that leaves ``LEAST_ROWS`` in each."""
    by_size = -(-rows * max(width, 1) * 8 // BLOCK_BYTES)
    return max(1, by_size, min(wanted, rows // LEAST_ROWS))


def over_grid(
    vectors: DataFrame, queries: DataFrame, run: Callable[[pa.Table, pa.Table, int], pa.Table], schema: str
) -> DataFrame:
    """``run(shard, block, width)`` for every pair of a shard of ``vectors`` and a block of ``queries``.

    Both sides are dealt by a hash of ``row``, so that no key, label or group of copies makes a
    shard larger than others, and a task holds one shard and one block of bounded bytes whatever
    the tables' sizes. Vectors travel once per block and queries once per shard; with n vectors and
    blocks of r rows that is some 2 * n * q / r rows instead of n * q pairs.
    """
    spark = vectors.sparkSession
    measures = (F.count(F.lit(1)), F.coalesce(F.max(F.size("values")), F.lit(0)))
    (n, wide), (q, wider) = vectors.agg(*measures).first(), queries.agg(*measures).first()
    width = max(wide, wider)
    shards = blocks_of(n, width, int(spark.conf.get("spark.sql.shuffle.partitions")))
    blocks = blocks_of(q, width, 1)

    def dealt(rows: DataFrame, own: str, count: int, other: str, times: int) -> DataFrame:
        return rows.withColumns(
            {own: F.pmod(F.xxhash64("row"), F.lit(count)).cast("int"), other: F.explode(F.sequence(F.lit(0), F.lit(times - 1)))}
        )

    left = dealt(vectors, "_shard", shards, "_block", blocks).groupBy("_shard", "_block")
    right = dealt(queries, "_block", blocks, "_shard", shards).groupBy("_shard", "_block")
    return left.cogroup(right).applyInArrow(lambda a, b: run(a, b, width), schema)
