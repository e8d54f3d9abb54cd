"""Global row positions and exact-size picks without a single-task stage."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.draws import DRAW_BITS, DRAW_SPAN, draw
from lakestrata.session import new_scratch

ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the low 33 bits
DIGIT_BITS = 12


def dense_index(df: DataFrame, order: Sequence[str], name: str = "idx", partitions: int | None = None) -> DataFrame:
    """``df`` with the 0-based position of every row in ascending ``order``.

    ``order`` must identify a row. Rows are range partitioned and sorted once; a row's position is
    its place in its partition plus the rows of all partitions before. The sorted rows are written
    to the scratch folder in between, because range bounds are sampled and must not be drawn twice.
    Pass only the columns that must travel with the position.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    path = new_scratch(spark, "index")
    ranged.sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(T.StructType([*df.schema, T.StructField("_id", T.LongType())])).parquet(path)
    stored = stored.withColumn("_part", F.shiftright("_id", ROW_BITS))
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).collect()
    offsets, before = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        offsets.append((row["_part"], before))
        before += row["_rows"]
    if not offsets:
        return df.withColumn(name, F.lit(0).cast("long")).filter(F.lit(False))
    # one small row per partition of the write above: bounded by the number of tasks
    table = F.broadcast(spark.createDataFrame(offsets, "_part long, _before long"))
    place = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.col("_before")
    return stored.join(table, "_part").withColumn(name, place).drop("_part", "_before", "_id")


def share_size(rows: int, share: float) -> int:
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    return int(rows * share)


def pick_condition(df: DataFrame, keys: Sequence[str], count: int, salt: str, rows: int | None = None) -> Column:
    """A condition that holds for exactly ``count`` rows of ``df``, chosen by a keyed hash.

    ``keys`` must identify a row. The rows are those with the least (hash, keys), so the choice
    depends on the data alone; pass the number of ``rows`` if it is known. No row moves: hashes are
    uniform, so the boundary lies within some standard deviations of its expected value, and one
    scan counts the rows below that bracket and sorts the few inside. The condition then compares
    each row with the boundary. Where keys repeat in the bracket, or it misses, the boundary is
    found by counting prefixes; rows that ``keys`` don't tell apart raise if it falls among them.
    """
    if count < 0:
        raise ValueError("count must not be negative")
    if count == 0:
        return F.lit(False)
    rows = df.count() if rows is None else rows
    if count >= rows:
        return F.lit(True)
    hashed = df.select(draw(salt, *keys).alias("_hash"), *keys)
    order = ["_hash", *keys]
    edge = _edge_in_bracket(hashed, order, count, rows) or _edge_by_prefixes(hashed, order, count)
    row = F.struct(draw(salt, *keys).alias("_hash"), *keys)
    return row <= F.struct(*(F.lit(edge[c]).cast(dict(hashed.dtypes)[c]).alias(c) for c in order))


def _edge_in_bracket(hashed: DataFrame, order: Sequence[str], count: int, rows: int) -> Row | None:
    """The ``count``-th row by ``order``, or None if the bracket around its expected hash doesn't settle it.

    The bracket has some ``16 * sqrt(rows)`` rows: 16 million of 10**12. They are a set, so copies
    of a key can't make it larger; if there are any, the bracket settles nothing.
    """
    width = (8 * math.sqrt(rows) + 64) / rows
    low, high = (min(max(int((count / rows + d) * DRAW_SPAN), 0), DRAW_SPAN) for d in (-width, width))
    inside = F.col("_hash").between(low, high)
    found = hashed.filter(F.col("_hash") <= high).agg(
        F.count_if(F.col("_hash") < low).alias("below"),
        F.count_if(inside).alias("inside"),
        F.collect_set(F.when(inside, F.struct(*order))).alias("set"),
    )
    place = (F.lit(count - 1) - F.col("below")).cast("int")
    seen = found.select("below", "inside", F.size("set").alias("distinct"), F.get(F.sort_array("set"), place).alias("edge")).first()
    settled = seen["below"] < count <= seen["below"] + seen["inside"] and seen["inside"] == seen["distinct"]
    return seen["edge"] if settled else None


def _edge_by_prefixes(hashed: DataFrame, order: Sequence[str], count: int) -> Row:
    """The same by counting hash prefixes, 12 bits per pass, until one row is left in the prefix that
    contains it, or the whole hash is used."""
    wanted, prefix, bits = count, 0, 0
    while True:
        within = hashed if bits == 0 else hashed.filter(_prefix(bits) == prefix)
        step = bits + DIGIT_BITS
        # at most 4096 rows by construction of the digit
        digits = within.groupBy(_prefix(step).alias("p")).count().collect()
        for row in sorted(digits, key=lambda r: r["p"]):
            if wanted <= row["count"]:
                break
            wanted -= row["count"]
        prefix, bits = row["p"], step
        if row["count"] == 1 or bits + DIGIT_BITS > DRAW_BITS:
            break
    last = hashed.filter(_prefix(bits) == prefix).orderBy(*order).limit(wanted).agg(F.max(F.struct(*order)))
    edge = last.collect()[0][0]
    alike = [F.col(c).eqNullSafe(F.lit(edge[c])) for c in order]
    if hashed.filter(reduce(and_, alike)).count() != 1:
        raise ValueError(f"columns {', '.join(order[1:])} do not identify a row")
    return edge


def _prefix(bits: int) -> Column:
    return F.shiftright("_hash", DRAW_BITS - bits)


def pick_fraction(df: DataFrame, keys: Sequence[str], share: float, salt: str, name: str = "picked") -> DataFrame:
    """``df`` with a flag that is true for exactly ``int(rows * share)`` rows."""
    rows = df.count()
    return df.withColumn(name, pick_condition(df, keys, share_size(rows, share), salt, rows))
