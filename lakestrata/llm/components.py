"""Connected components over an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.session import new_scratch

#: edges a file of a step holds; a tiny file for every shuffle partition costs more than its edges
FILE_EDGES = 10_000
CHANGED = ("count(1)", "coalesce(sum(cast(xxhash64(node, other) as decimal(38,0))), 0)")


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """One row ``(node, component)`` per node of an edge between two different nodes.

    ``component`` is the least node reachable. Edges may repeat, run both ways, be loops or hold
    NULL (ignored). Every step links each neighbour with the least one it knows, so the number of
    edges never grows and the number of steps is logarithmic in practice; each is written to the
    shared scratch folder. A hub is no hot group: minima combine before their shuffle, and the
    join that hands them back has one row per node on its other side, so Spark can split it.
    """
    a, b = F.col(first), F.col(second)
    now, said = _store(
        edges.filter(a != b).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).distinct()
    )
    while said[0]:
        before = said
        both = now.unionByName(now.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = both.groupBy("node").agg(F.least("node", F.min("other")).alias("least"))
        large = both.join(least, "node").filter("other > node and other > least").select(
            F.col("other").alias("node"), F.col("least").alias("other")
        )
        now, _ = _store(large.distinct(), said[0])
        least = now.groupBy("node").agg(F.min("other").alias("least"))
        small = now.join(least, "node").filter("other > least").select(F.col("other").alias("node"), F.col("least").alias("other"))
        now, said = _store(small.unionByName(least.select("node", F.col("least").alias("other"))).distinct(), before[0])
        if said == before:
            break
    roots = now.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    return now.select("node", F.col("other").alias("component")).unionByName(roots)


def _store(edges: DataFrame, at_most: int | None = None) -> tuple[DataFrame, tuple]:
    """The written edges, and their number and checksum; where there are ``at_most`` so many, in few files."""
    spark = edges.sparkSession
    path = new_scratch(spark, "edges")
    if at_most is not None:
        edges = edges.coalesce(-(-at_most // FILE_EDGES))
    edges.write.parquet(path)
    stored = spark.read.schema(edges.schema).parquet(path)
    return stored, tuple(stored.selectExpr(*CHANGED).first())
