"""Left join on a computed position, by blocks of a stored dense index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.latest import orderable

BLOCK_ROWS = 1_024
PART_ROWS = 1_000_000
MOST_SPLIT_BLOCKS = 100_000
NO_BLOCK = -1


def join_by_position(
    children: DataFrame,
    slot: str,
    indexed: DataFrame,
    position: str = "idx",
    spread: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``children`` with the columns of the ``indexed`` row at the position in ``slot``.

    ``indexed`` numbers its rows 0 to n - 1 without gaps, as ``dense_index`` does. A slot that is NULL,
    negative or past the end finds nothing, its columns are NULL. The columns of both sides must have
    different names.

    Positions need no key lookup: the index is cut into blocks of neighbours, each one row with an
    array, and a child takes its place in its block's array. Children per block are counted first;
    a block with more than ``part_rows`` of them (a hot slot, NULL slots, few parents under many
    children) is dealt over several parts by a hash of the ``spread`` columns, by default all that
    can be hashed, and sent to each of them. So a slot that holds a third of all rows is shared
    among tasks, whether adaptive execution is on or not. Rows that agree in all of ``spread`` stay
    together. The parts travel as a broadcast of ``MOST_SPLIT_BLOCKS`` small rows at most.
    """
    if block_rows < 1 or part_rows < 1:
        raise ValueError("block_rows and part_rows must be at least 1")
    clash = set(children.columns) & set(indexed.columns) - {position}
    if clash:
        raise ValueError(f"both sides have the columns {', '.join(sorted(clash))}")
    spread = spread or [f.name for f in children.schema if orderable(f.dataType)]
    at = F.col(f"`{slot}`").cast("long")
    block = F.when(at >= 0, F.floor(at / F.lit(block_rows))).otherwise(F.lit(NO_BLOCK)).cast("long")
    placed = children.select("*", F.coalesce(block, F.lit(NO_BLOCK)).alias("_block"))
    counts = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_rows"))
    total = placed.count()
    per_part = max(part_rows, -(-total // MOST_SPLIT_BLOCKS))
    # fewer than total / per_part blocks can hold more than per_part rows
    split = F.broadcast(counts.filter(F.col("_rows") > per_part).select("_block", F.ceil(F.col("_rows") / per_part).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = (
        placed.join(split, "_block", "left")
        .withColumn("_part", F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in spread)), parts).cast("int"))
        .drop("_parts")
    )
    carried = [c for c in indexed.columns if c != position]
    held = F.struct(F.col(position).alias("_at"), *(F.col(f"`{c}`") for c in carried))
    blocks = (
        indexed.groupBy(F.floor(F.col(position) / F.lit(block_rows)).cast("long").alias("_block"))
        .agg(F.sort_array(F.collect_list(held)).alias("_neighbours"))
        .join(split, "_block", "left")
        .select("_block", "_neighbours", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    )
    found = F.get("_neighbours", F.pmod(at, F.lit(block_rows)).cast("int"))
    joined = dealt.join(blocks, ["_block", "_part"], "left").withColumn("_found", found)
    return joined.select(*(F.col(f"`{c}`") for c in children.columns), *(F.col("_found").getField(c).alias(c) for c in carried))
