"""Left join on a computed position."""

import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.index import dense_index
from lakestrata.operators.lookup import join_by_position
from tests.test_plans import plan


def test_against_python(spark):
    draw = random.Random(1)
    names = [f"p{i:03d}" for i in range(137)]
    index = dense_index(spark.createDataFrame([(n, n.upper()) for n in names], "name string, title string").repartition(4), ["name"], partitions=4)
    slots = [draw.choice([None, -1, 137, 500, 20, 20, draw.randrange(137)]) for _ in range(600)]
    children = spark.createDataFrame(list(enumerate(slots)), "id long, at int")
    want = [(i, s, *((names[s], names[s].upper()) if s is not None and 0 <= s < 137 else (None, None))) for i, s in enumerate(slots)]
    for options in ({}, {"block_rows": 10, "part_rows": 7}, {"block_rows": 1, "part_rows": 1_000, "spread": ["id"]}):
        got = join_by_position(children, "at", index, **options)
        assert got.columns == ["id", "at", "name", "title"]
        assert sorted(map(tuple, got.collect())) == want


def test_nothing_on_either_side(spark):
    index = dense_index(spark.range(5).withColumnRenamed("id", "key"), ["key"])
    none = spark.createDataFrame([], "id long, at int")
    assert join_by_position(none, "at", index).count() == 0
    some = spark.createDataFrame([(1, 0), (1, 0)], "id long, at int")
    assert [r["key"] for r in join_by_position(some, "at", index.limit(0)).collect()] == [None, None]
    assert [r["key"] for r in join_by_position(some, "at", index).collect()] == [0, 0]
    with pytest.raises(ValueError, match="both sides"):
        join_by_position(some.withColumnRenamed("id", "key"), "at", index)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_no_task_holds_a_hot_slot_alone(spark, adaptive):
    """A third of 60,000 wide rows at one position: at most two of its parts meet in a task."""
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        children = spark.range(60_000).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("wide"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 4_000).alias("at")
        )
        index = dense_index(spark.range(4_000).withColumnRenamed("id", "key"), ["key"])
        joined = join_by_position(children, "at", index, block_rows=100, part_rows=1_000)
        assert "CartesianProduct" not in plan(joined) and "NestedLoop" not in plan(joined)
        held = joined.filter("key = 5").groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.max("wide")).collect()
        assert sum(r["n"] for r in held) == 20_010
        if adaptive == "false":
            assert len(held) == 8 and max(r["n"] for r in held) < 7_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
