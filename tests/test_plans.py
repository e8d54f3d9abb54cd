"""Physical plans: what must be there at scale, and what must not."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from lakestrata.plans.queries import registered
from lakestrata.operators import changes, index, layout
from lakestrata.operators.joins import left_once, orphan_rows
from tests.conftest import SF


@pytest.fixture
def shuffled(spark):
    """No broadcast by size: the plan of inputs too large for it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def explain(spark, name):
    return plan(registered()[name][0](spark, SF))


def nodes(text, name):
    tree = text.split("\n\n\n")[0]
    return len(re.findall(rf"[:+]- \*?.*\b{name}\b", tree))


def test_latest_limits_before_the_shuffle(shuffled):
    text = explain(shuffled, "e1_latest_per_key")
    assert nodes(text, "WindowGroupLimit") == 2 and nodes(text, "Exchange") == 1


def test_profile_shuffles_each_input_once(shuffled):
    text = explain(shuffled, "flagship_customer_profile")
    assert nodes(text, "Exchange") == 3 and nodes(text, "SortMergeJoin") == 2


def test_metrics_combine_before_the_shuffle(shuffled):
    text = explain(shuffled, "d1_conditional_metrics")
    assert nodes(text, "HashAggregate") == 2 and nodes(text, "Exchange") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = explain(spark, "b6_comparison_filter")
    assert "GreaterThan(l_quantity,10.0)" in text and "Not(EqualTo(l_returnflag,R))" in text
    assert "l_shipdate" not in re.search(r"ReadSchema: (.*)", text).group(1)


def test_whole_table_checks_read_only_their_columns(spark):
    assert "ReadSchema: struct<l_partkey:bigint>" in explain(spark, "d6_distinct_count")
    assert "ReadSchema: struct<>" in explain(spark, "d4_global_count")


def test_mutation_does_not_shuffle(spark):
    text = explain(spark, "l9_snapshot_mutation")
    assert nodes(text, "Exchange") == 0 and nodes(text, "Sort") == 0


def test_pick_does_not_shuffle(spark):
    text = explain(spark, "e3_exact_fraction")
    assert "Exchange" not in text and "Window" not in text


def test_top_k_sorts_no_more_than_k(spark):
    assert "TakeOrderedAndProject" in explain(spark, "f2_filtered_top_k")


def test_references_are_checked_on_distinct_keys(shuffled):
    text = explain(shuffled, "j4_reference_check")
    assert nodes(text, "HashAggregate") == 4
    assert "HashAggregate" in text[text.index("SortMergeJoin LeftAnti"):].split("\n\n\n")[0]


def test_folder_keys_prune_folders(spark, tmp_path):
    spark.range(100).withColumn("day", F.col("id") % 5).write.partitionBy("day").parquet(f"{tmp_path}/t")
    text = plan(spark.read.parquet(f"{tmp_path}/t").filter("day = 3"))
    assert re.search(r"PartitionFilters: \[.*day.* = 3", text)


@pytest.mark.parametrize("name", sorted(registered()))
def test_no_python_and_no_cross_join(spark, name):
    if name.startswith(("a", "i", "k1", "k2", "bank_two")):
        pytest.skip("writes before it reads; the same operators are covered above")
    text = explain(spark, name)
    for bad in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_index_has_no_single_task_stage(spark, monkeypatch):
    """Neither the sort nor the numbering may gather all rows in one partition."""
    seen = []
    from pyspark.sql.readwriter import DataFrameWriter

    write = DataFrameWriter.parquet

    def watch(self, path, **options):
        seen.append(plan(self._df))
        return write(self, path, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", watch)
    out = index.dense_index(spark.range(10_000).repartition(8), ["id"], partitions=8)
    (text,) = seen
    assert "rangepartitioning" in text and "SinglePartition" not in text and "Window" not in text
    assert "SinglePartition" not in plan(out) and "Window" not in plan(out)


@pytest.mark.parametrize("kind", ["left", "anti"])
def test_hot_keys_are_split_at_run_time(shuffled, kind):
    """A key with nine rows in ten: one plan at every size, its partition read in several parts."""
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in small.items():
        shuffled.conf.set(key, value)
    try:
        key = F.when(F.col("id") % 10 != 0, 1).otherwise(F.col("id"))
        many = shuffled.range(200_000).repartition(8).select(key.cast("long").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        one = shuffled.range(2, 50_000).select(F.col("id").alias("k"), F.lit("x").alias("name")).repartition(4)
        joined = left_once(many, one, ["k"]) if kind == "left" else orphan_rows(many, one.withColumnRenamed("k", "pk"), "k", "pk")
        # the value must travel, or hardly any bytes would
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("v")).collect()]
        assert "Broadcast" not in plan(joined)
        assert sum(sizes) >= 180_000 and max(sizes) < 90_000
    finally:
        for key in small:
            shuffled.conf.unset(key)


def test_compaction_does_not_shuffle(spark, tmp_path, monkeypatch):
    spark.range(100).repartition(4).write.parquet(f"{tmp_path}/in")
    seen = []
    publish = layout.publish
    monkeypatch.setattr(layout, "publish", lambda df, root, folder: (seen.append(plan(df)), publish(df, root, folder)))
    layout.compact(spark, f"{tmp_path}/in", str(tmp_path), "out")
    assert "Exchange" not in seen[0]


def test_current_rows_sort_by_their_identity_alone(shuffled):
    text = explain(shuffled, "bank_silver_customers")
    sorts = re.findall(r"row_number\(\) windowspecdefinition\((.*?) specifiedwindowframe", text)
    assert len(sorts) == 2
    for order in sorts:
        assert len(re.findall(r"(?:ASC|DESC) NULLS", order)) == 4


def test_unchanged_rows_move_as_key_and_digest(spark):
    """Whole rows of a snapshot are shuffled in neither phase while few keys changed."""
    old = spark.read.parquet(f"{SF}/orders.parquet")
    new = old.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 1000 == 0, 0.0).otherwise(F.col("o_totalprice")))
    first = plan(changes.changed_keys(old, new, ["o_orderkey"]))
    moved = re.findall(r"\(\d+\) Exchange.*?Input \[\d+\]: \[([^\]]*)\]", first, re.S)
    assert moved and all("o_orderstatus" not in m and "o_totalprice" not in m for m in moved)
    feed = changes.snapshot_changes(old, new, ["o_orderkey"])
    assert nodes(plan(feed), "BroadcastHashJoin") >= 2
    assert feed.count() > 0
