"""Incremental results equal full recomputes, also after replays."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.aggregate import Metric, conditional_metrics
from lakestrata.operators.latest import latest_per_key
from lakestrata.sources import fs
from lakestrata.sources.tables import numbered, subfolders
from lakestrata.streaming import group_refresh as groups
from lakestrata.streaming.append import append_refresh, read_appended
from lakestrata.streaming.key_refresh import BATCH, join_refresh, key_refresh, prune, read_keyed

METRICS = (Metric("n_a", "count", "a"), Metric("avg_b", "avg", "b"), Metric("sum_c", "sum", "c"))
SCHEMA = "k long, t string, v double, at long"


def rows(first, last):
    return [(i % 7, "abcd"[i % 4], float(i) / 4 if i % 5 else None, i) for i in range(first, last)]


def forget_commit(spark, checkpoint, number):
    for name in (f"{number}", f".{number}.crc"):
        fs.delete(spark, f"{checkpoint}/commits/{name}")


def rowset(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


class Flow:
    def __init__(self, spark, root):
        self.spark, self.root, self.all = spark, str(root), []

    def add(self, new, name="in", schema=SCHEMA):
        self.all += new
        self.spark.createDataFrame(new, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def stream(self, name="in", schema=SCHEMA, files=None):
        reader = self.spark.readStream.schema(schema)
        return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(f"{self.root}/{name}")

    def frame(self):
        return self.spark.createDataFrame(self.all, SCHEMA)


@pytest.fixture
def flow(spark, tmp_path):
    return Flow(spark, tmp_path)


def refresh(flow, **options):
    groups.group_refresh(flow.stream(files=1), f"{flow.root}/m", f"{flow.root}/c", "k", "t", "v", **options)
    return groups.read_metrics(flow.spark, f"{flow.root}/m", "k", METRICS)


@pytest.mark.parametrize("fold_after", [1, 2, 64])
def test_group_refresh_equals_full(flow, fold_after):
    for step in range(5):
        flow.add(rows(step * 20, step * 20 + 20))
        have = refresh(flow, scale=2, fold_after=fold_after)
        want = conditional_metrics(flow.frame(), "k", "t", "v", METRICS, scale=2)
        assert rowset(have) == rowset(want)
    assert rowset(refresh(flow, scale=2)) == rowset(want)


@pytest.mark.parametrize("fold_after", [1, 64])
def test_group_refresh_replay(flow, fold_after):
    flow.add(rows(0, 30))
    refresh(flow, fold_after=fold_after)
    flow.add(rows(30, 60))
    before = rowset(refresh(flow, fold_after=fold_after))
    forget_commit(flow.spark, f"{flow.root}/c", 1)
    assert rowset(refresh(flow, fold_after=fold_after)) == before


def test_fold_removes_only_what_is_two_folds_old(flow):
    for step in range(4):
        flow.add(rows(step * 10, step * 10 + 10))
        refresh(flow, fold_after=1)
    target = f"{flow.root}/m"
    assert numbered(flow.spark, target, groups.FOLDED) == [2, 3]
    assert numbered(flow.spark, target, groups.BATCH) == [3]


def keyed(flow, buckets=4):
    schema = flow.stream().schema
    key_refresh(flow.stream(files=1), f"{flow.root}/k", f"{flow.root}/kc", ["k"], ["at"], buckets)
    return read_keyed(flow.spark, f"{flow.root}/k", schema)


def test_key_refresh_equals_full(flow):
    # later deliveries may carry older rows
    for first, last in ((40, 60), (0, 20), (20, 40), (60, 61)):
        flow.add(rows(first, last))
        assert rowset(keyed(flow)) == rowset(latest_per_key(flow.frame(), ["k"], ["at"]))


def test_key_refresh_replay_and_prune(flow):
    flow.add(rows(0, 20))
    keyed(flow)
    flow.add(rows(20, 21))
    before = rowset(keyed(flow))
    forget_commit(flow.spark, f"{flow.root}/kc", 1)
    assert rowset(keyed(flow)) == before
    touched = subfolders(flow.spark, f"{flow.root}/k/{BATCH}=1", "bucket")
    assert len(touched) == 1
    prune(flow.spark, f"{flow.root}/k")
    assert not set(touched) & set(subfolders(flow.spark, f"{flow.root}/k/{BATCH}=0", "bucket"))
    assert rowset(read_keyed(flow.spark, f"{flow.root}/k", flow.stream().schema)) == before


def test_key_refresh_interrupted_write_is_repeated(flow):
    flow.add(rows(0, 20))
    keyed(flow)
    flow.add(rows(20, 40))
    before = rowset(keyed(flow))
    forget_commit(flow.spark, f"{flow.root}/kc", 1)
    fs.delete(flow.spark, f"{flow.root}/k/{BATCH}=1")
    assert rowset(keyed(flow)) == before


def test_join_refresh_touches_changed_buckets_only(spark, flow):
    names = "k long, name string, at long"

    def run():
        key_refresh(flow.stream("p", names), f"{flow.root}/p1", f"{flow.root}/pc", ["k"], ["at"], 4)
        key_refresh(flow.stream(), f"{flow.root}/k", f"{flow.root}/kc", ["k"], ["at"], 4)
        left, right = (f"{flow.root}/p1", flow.stream("p", names).schema), (f"{flow.root}/k", flow.stream().schema)
        build = lambda p, r: p.drop("at").join(r.select("k", "v", "at"), "k", "left")
        changed = join_refresh(spark, left, right, f"{flow.root}/view", ["k"], 4, build)
        return changed, rowset(read_keyed(spark, f"{flow.root}/view", build(flow.spark.createDataFrame([], left[1]), flow.spark.createDataFrame([], right[1])).schema))

    people = [(i, f"p{i}", 0) for i in range(10)]
    spark.createDataFrame(people, names).coalesce(1).write.mode("append").parquet(f"{flow.root}/p")
    flow.add(rows(0, 20))

    def full():
        newest = latest_per_key(flow.frame(), ["k"], ["at"]).select("k", "v", "at")
        return rowset(spark.createDataFrame(people, names).drop("at").join(newest, "k", "left"))

    changed, view = run()
    assert changed and view == full()
    changed, view = run()
    assert changed == [] and view == full()
    flow.add([(3, "a", 99.0, 1000)])
    changed, view = run()
    assert len(changed) == 1 and view == full()


def test_append_refresh_takes_row_by_row_work_only(flow):
    flow.add(rows(0, 10))
    with pytest.raises(Exception, match="STREAMING_OUTPUT_MODE|watermark"):
        append_refresh(flow.stream(), lambda df: df.groupBy("k").count(), f"{flow.root}/x", f"{flow.root}/xc")
    with pytest.raises(ValueError):
        append_refresh(flow.frame(), lambda df: df, f"{flow.root}/x", f"{flow.root}/xc")


def test_append_refresh_equals_full(flow):
    double = lambda df: df.select("at", (F.col("v") * 2).alias("w"))
    for step in range(3):
        flow.add(rows(step * 10, step * 10 + 10))
        append_refresh(flow.stream(), double, f"{flow.root}/x", f"{flow.root}/xc")
        append_refresh(flow.stream(), double, f"{flow.root}/x", f"{flow.root}/xc")
        assert rowset(read_appended(flow.spark, f"{flow.root}/x", double(flow.frame()).schema)) == rowset(double(flow.frame()))


def test_lost_checkpoints_raise(flow):
    flow.add(rows(0, 10))
    same = lambda df: df
    append_refresh(flow.stream(), same, f"{flow.root}/x", f"{flow.root}/xc")
    groups.group_refresh(flow.stream(), f"{flow.root}/m", f"{flow.root}/c", "k", "t", "v")
    flow.add(rows(10, 20))
    with pytest.raises(ValueError, match="is new"):
        append_refresh(flow.stream(), same, f"{flow.root}/x", f"{flow.root}/other")
    with pytest.raises(ValueError, match="is new"):
        groups.group_refresh(flow.stream(), f"{flow.root}/m", f"{flow.root}/other", "k", "t", "v")


def test_metrics_may_change_between_runs(flow):
    flow.add(rows(0, 40))
    groups.group_refresh(flow.stream(), f"{flow.root}/m", f"{flow.root}/c", "k", "t", "v")
    other = [Metric("n", "count", "b"), Metric("s", "sum", "a")]
    have = groups.read_metrics(flow.spark, f"{flow.root}/m", "k", other)
    assert rowset(have) == rowset(conditional_metrics(flow.frame(), "k", "t", "v", other))
