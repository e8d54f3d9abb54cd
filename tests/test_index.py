import pytest
from pyspark.sql import functions as F

from lakestrata.functions.draws import draw, pick, weighted
from lakestrata.operators import index


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_dense_index_any_partitioning(spark, parts):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), F.lit("same").alias("b")).repartition(parts)
    out = index.dense_index(df, ["b", "a"], partitions=parts)
    rows = sorted((r["idx"], r["a"]) for r in out.collect())
    assert [i for i, _ in rows] == list(range(5000))
    assert [a for _, a in rows] == sorted(a for _, a in rows)


def test_dense_index_of_nothing(spark):
    out = index.dense_index(spark.range(0), ["id"])
    assert out.count() == 0 and out.columns == ["id", "idx"]


@pytest.mark.parametrize("count", [0, 1, 37, 999, 1000, 1500])
def test_pick_exact_count(spark, count):
    df = spark.range(1000).repartition(5)
    flag = index.pick_condition(df, ["id"], count, "s")
    picked = {r["id"] for r in df.filter(flag).collect()}
    order = sorted((r["h"], r["id"]) for r in df.select(draw("s", "id").alias("h"), "id").collect())
    assert picked == {i for _, i in order[:count]}


@pytest.mark.parametrize("count", [1, 3_000, 11_999, 19_999])
def test_both_ways_find_the_same_edge(spark, count):
    hashed = spark.range(20_000).repartition(4).select(draw("s", "id").alias("_hash"), "id")
    edge = index._edge_in_bracket(hashed, ["_hash", "id"], count, 20_000)
    assert edge is not None and edge == index._edge_by_prefixes(hashed, ["_hash", "id"], count)


def test_a_hot_key_beside_the_boundary(spark):
    """Copies of one key are half of all rows: picks on either side of them are exact, within them they raise."""
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    below = df.filter(draw("s", "k") < draw("s", F.lit(-1))).count()
    for count in (below // 2, below, below + 20_001, below + 20_500):
        assert df.filter(index.pick_condition(df, ["k"], count, "s")).count() == count
    with pytest.raises(ValueError, match="do not identify"):
        index.pick_condition(df, ["k"], below + 9_000, "s")


def test_a_pick_scans_the_rows_once(spark):
    """Beside the count, which needs no column, and the result itself."""
    df, seen = spark.range(30_000).withColumn("k", F.col("id")), []
    collect = index._edge_in_bracket
    try:
        index._edge_in_bracket = lambda *args: (seen.append("bracket"), collect(*args))[1]
        assert df.filter(index.pick_condition(df, ["k"], 7_000, "s")).count() == 7_000
    finally:
        index._edge_in_bracket = collect
    assert seen == ["bracket"]


def test_pick_with_several_key_columns(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), F.concat(F.lit("x"), F.floor(F.col("id") / 10)).alias("b"))
    assert df.filter(index.pick_condition(df, ["a", "b"], 33, "s")).count() == 33


def test_pick_rejects_repeated_keys(spark):
    df = spark.range(100).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="do not identify"):
        index.pick_condition(df, ["k"], 10, "s")


@pytest.mark.parametrize("rows", [30, 3_000])
def test_repeated_keys_behave_alike_at_any_size(spark, rows):
    df = spark.range(rows).select((F.col("id") % 3).alias("k"))
    with pytest.raises(ValueError, match="do not identify"):
        index.pick_condition(df, ["k"], rows // 2, "s")


def test_share_size():
    assert index.share_size(1500, 0.006) == 9
    assert index.share_size(50_000, 0.2) == 10_000
    for bad in (0, 1.5, -0.1):
        with pytest.raises(ValueError):
            index.share_size(10, bad)


def test_draws_do_not_depend_on_partitioning(spark):
    one = spark.range(500).coalesce(1).select("id", pick(("a", "b", "c"), "s", "id").alias("v"))
    many = spark.range(500).repartition(9).select("id", pick(("a", "b", "c"), "s", "id").alias("v"))
    assert sorted(one.collect()) == sorted(many.collect())


def test_weights_are_met(spark):
    rows = spark.range(20_000).select(weighted((("a", 60), ("b", 30), ("c", 10)), "w", "id").alias("v")).groupBy("v").count().collect()
    share = {r["v"]: r["count"] / 200 for r in rows}
    assert abs(share["a"] - 60) < 2 and abs(share["b"] - 30) < 2 and abs(share["c"] - 10) < 2
    with pytest.raises(ValueError):
        weighted((("a", 0),), "w", "id")
