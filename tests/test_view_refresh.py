"""The state-backed view equals the join of latest rows, whatever the deliveries, replays and folds."""

import json

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.joins import left_once
from lakestrata.operators.latest import latest_per_key
from lakestrata.sources import fs
from lakestrata.sources.checked import RULES_FILE, rule_counts
from lakestrata.sources.tables import numbered
from lakestrata.streaming import view_refresh as views
from tests.test_streaming import forget_commit, rowset

LEFT, RIGHT = "k long, name string, at long", "k long, v double, at2 long"
RULES = {"known": "v IS NOT NULL", "large": "v > 10"}


class Pair:
    """Two landing folders, and the view kept from them."""

    def __init__(self, spark, root):
        self.spark, self.root, self.own = spark, str(root), views.stateful_session(spark, 3)
        self.rows = {"left": [], "right": []}
        self.schemas = {"left": LEFT, "right": RIGHT}
        for side in self.rows:
            self.add(side, [])

    def add(self, side, new):
        self.rows[side] += new
        self.spark.createDataFrame(new, self.schemas[side]).coalesce(1).write.mode("append").parquet(f"{self.root}/{side}")

    @staticmethod
    def build(pairs):
        return pairs.select("k", "left.name", "right.v", F.coalesce("right.v", F.lit(0.0)).alias("v0"))

    def refresh(self, **options):
        streams = (self.own.readStream.schema(self.schemas[s]).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/{s}") for s in self.rows)
        views.view_refresh(*streams, f"{self.root}/view", f"{self.root}/c", ["k"], (["at"], ["at2"]), self.build, ["k"], RULES, **options)
        return rowset(self.read())

    def read(self):
        left, right = (self.spark.createDataFrame([], s) for s in (LEFT, RIGHT))
        schema = self.build(views.newest_pairs(left, right, ["k"], (["at"], ["at2"]))).schema
        return views.read_view(self.spark, f"{self.root}/view", schema, ["k"])

    def full(self):
        left, right = (self.spark.createDataFrame(self.rows[s], self.schemas[s]) for s in self.rows)
        joined = left_once(latest_per_key(left, ["k"], ["at"]), latest_per_key(right, ["k"], ["at2"]), ["k"])
        return rowset(joined.select("k", "name", "v", F.coalesce("v", F.lit(0.0)).alias("v0")))


@pytest.fixture
def pair(spark, tmp_path):
    return Pair(spark, tmp_path)


@pytest.mark.parametrize("fold_after", [1, 2, 50])
def test_equals_the_join_of_latest_rows(pair, fold_after):
    assert pair.refresh(fold_after=fold_after) == []
    # right rows before their left one, older rows later, ties, NULL keys, NULL times, equal rows twice
    pair.add("right", [(1, 5.0, 10), (2, 50.0, 10), (9, 1.0, 1), (None, 7.0, 1)])
    assert pair.refresh(fold_after=fold_after) == pair.full() == []
    pair.add("left", [(1, "a", 1), (2, "b", 1), (3, "c", None), (None, "n", 1), (None, "m", 1)])
    assert pair.refresh(fold_after=fold_after) == pair.full()
    pair.add("left", [(1, "older", 0), (2, "b2", 1), (3, "c", None), (4, "d", 5)])
    pair.add("right", [(1, 4.0, 10), (2, None, 11), (3, 3.0, None), (4, 12.0, 1)])
    assert pair.refresh(fold_after=fold_after) == pair.full()
    pair.add("right", [(4, 99.0, 2)])
    assert pair.refresh(fold_after=fold_after) == pair.full()
    assert pair.refresh(fold_after=fold_after) == pair.full()
    folds = numbered(pair.spark, f"{pair.root}/view", views.FOLDED)
    assert len(folds) == (0 if fold_after == 50 else 2)


def test_only_changed_keys_are_written(pair):
    pair.add("left", [(i, f"n{i}", 1) for i in range(500)])
    pair.refresh()
    pair.add("right", [(7, 1.0, 1), (8, 1.0, 1)])
    pair.refresh()
    *_, last = numbered(pair.spark, f"{pair.root}/view", views.BATCH)
    assert rowset(pair.spark.read.parquet(f"{pair.root}/view/batch={last}").select("k")) == [(7,), (8,)]


@pytest.mark.parametrize("lost", ["commit", "commit and folder"])
def test_replayed_batches_change_nothing(pair, lost):
    pair.add("left", [(i, f"n{i}", 1) for i in range(20)])
    pair.add("right", [(i, float(i), 1) for i in range(0, 20, 2)])
    pair.refresh()
    pair.add("right", [(i, 100.0, 2) for i in range(5)])
    before = pair.refresh()
    *_, last = numbered(pair.spark, f"{pair.root}/view", views.BATCH)
    counts = rule_counts(pair.spark, f"{pair.root}/view", [f"batch={last}"])
    assert counts == {"known": [5, 0, 0], "large": [5, 0, 0]}
    forget_commit(pair.spark, f"{pair.root}/c", last)
    if lost != "commit":
        fs.delete(pair.spark, f"{pair.root}/view/batch={last}")
    assert pair.refresh() == before == pair.full()
    assert rule_counts(pair.spark, f"{pair.root}/view", [f"batch={last}"]) == counts
    pair.add("left", [(1, "new", 9)])
    assert pair.refresh() == pair.full()


def test_rules_are_counted_while_writing(pair):
    pair.add("left", [(1, "a", 1), (2, "b", 1), (3, "c", 1)])
    pair.add("right", [(1, 5.0, 1), (2, 50.0, 1)])
    pair.refresh()
    folders = [f"batch={n}" for n in numbered(pair.spark, f"{pair.root}/view", views.BATCH)]
    assert sum(json.loads(fs.read_text(pair.spark, f"{pair.root}/view/{f}/{RULES_FILE}"))["large"][0] for f in folders) >= 1
    met, unmet, unknown = rule_counts(pair.spark, f"{pair.root}/view", folders)["large"]
    assert met == 1 and unmet >= 2 and unknown >= 1


def test_bad_calls(spark, pair):
    frame = spark.createDataFrame([], LEFT)
    with pytest.raises(ValueError, match="streaming"):
        views.view_refresh(frame, frame, "t", "c", ["k"], (["at"], ["at"]), pair.build, ["k"])
    with pytest.raises(ValueError, match="no order"):
        views.newest_pairs(spark.createDataFrame([], "k long, at long, m map<string,string>"), frame, ["k"], (["at"], ["at"]))
    with pytest.raises(ValueError, match="newest_by"):
        views.newest_pairs(frame, frame, ["k"], ([], ["at"]))
    with pytest.raises(ValueError, match="partitions"):
        views.stateful_session(spark, 0)
    pair.add("left", [(1, "a", 1)])
    pair.refresh()
    with pytest.raises(ValueError, match="is new"):
        fs.delete(spark, f"{pair.root}/c")
        pair.refresh()
