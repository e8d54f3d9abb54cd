import pytest
from pyspark.sql import functions as F

from lakestrata.operators.joins import left_once, orphan_keys, orphan_rows
from lakestrata.operators.latest import latest_per_key


def many(spark):
    """A hot key with distinct rows, a hot key of pure copies, NULL keys, and a tail."""
    n = 3000
    key = F.when(F.col("id") < 1000, 1).when(F.col("id") < 2000, 2).when(F.col("id") < 2300, F.lit(None)).otherwise(F.col("id") % 50)
    value = F.when((F.col("id") >= 1000) & (F.col("id") < 2000), 7).otherwise(F.col("id"))
    return spark.range(n).repartition(6, "id").select(key.cast("long").alias("k"), value.alias("v"))


def one(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "n"), (99, "z")], "k long, name string")


def test_left_once_keeps_null_and_unmatched_keys(spark):
    joined = left_once(many(spark), one(spark), ["k"])
    assert joined.columns == ["k", "v", "name"]
    assert joined.filter("k is null").count() == 300 and joined.filter("k is null and name is not null").count() == 0
    assert joined.count() == many(spark).count() + many(spark).filter("k = 1").count()


def test_orphans_of_hot_and_null_keys(spark):
    found = orphan_rows(many(spark), one(spark).withColumnRenamed("k", "pk"), "k", "pk")
    assert found.filter("k is null or k in (1, 3)").count() == 0
    assert found.count() == many(spark).filter("k not in (1, 3)").count()


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 8), (3, 8), (4, None)], "id int, fk long")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "pk long")
    assert [tuple(r) for r in orphan_keys(child, parent, "fk", "pk").collect()] == [(8, 2)]
    assert sorted(r["id"] for r in orphan_rows(child, parent, "fk", "pk").collect()) == [2, 3]


@pytest.mark.parametrize("seed", range(4))
def test_latest_ignores_partitioning_and_order(spark, seed):
    rows = [(k, t, f"r{i}") for i, (k, t) in enumerate([(1, 5), (1, 5), (1, 4), (2, None), (2, None), (3, 1), (None, 2), (None, 2)])]
    df = spark.createDataFrame(rows, "k int, t int, r string").orderBy(F.rand(seed)).repartition(seed + 1)
    assert sorted(map(tuple, latest_per_key(df, ["k"], ["t"]).collect()), key=repr) == sorted(
        [(1, 5, "r1"), (2, None, "r4"), (3, 1, "r5"), (None, 2, "r7")], key=repr
    )


def test_latest_skips_unorderable_columns(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2})], "k int, t int, m map<string,int>")
    assert latest_per_key(df, ["k"], ["t"]).first()["m"] == {"b": 2}


def test_latest_needs_an_order(spark):
    with pytest.raises(ValueError):
        latest_per_key(many(spark), ["k"], [])
