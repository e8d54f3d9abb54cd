import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import negatives as module
from lakestrata.llm import vectors as grid
from lakestrata.llm.negatives import Shard, hard_negatives
from tests.llm.helpers import ODD_VECTORS, VECTORS, drawn_vectors, inner, rows, vectors, whole_numbers


def expected(items, positives=5, negatives=3):
    kept = [(i, v, (k + 1) % 10 if i is not None and i % 7 == 0 else k) for i, v, k in whole_numbers(items) if k is not None]
    found = []
    for n, (key, a, label) in enumerate(kept):
        if key is None or key % 50:
            continue
        ranked = sorted((-inner(a, v), i is None, i or 0, k) for m, (i, v, k) in enumerate(kept) if m != n)
        name = lambda x: None if x[1] else x[2]
        for p in [x for x in ranked if x[3] == label][:positives]:
            fit = [x for x in ranked if x[3] != label and 50 * -p[0] <= 100 * -x[0] <= 95 * -p[0]][:negatives]
            found += [(key, name(p), r, name(x), -p[0], -x[0]) for r, x in enumerate(fit, 1)]
    return sorted(found, key=str)


def got(spark, items, **how):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    columns = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    made = rows(hard_negatives(vectors(spark, items), F.col("vec_id") % 50 == 0, label, **how))
    return sorted((tuple(r[c] for c in columns) for r in made), key=str)


@pytest.mark.parametrize("positives, negatives", [(5, 3), (1, 100)])
def test_odd_vectors(spark, positives, negatives):
    want = expected(ODD_VECTORS, positives, negatives)
    assert want and got(spark, ODD_VECTORS, positives=positives, negatives=negatives) == want


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK_BYTES", 6 * 8 * 40)
    items = drawn_vectors(1, 700, 6) + [(i, [1.0, -1.0, 0.5, 0.0, 0.0, 0.0], 1) for i in range(1_000, 1_300)]
    assert got(spark, items) == expected(items)


def test_empty_tables(spark):
    assert rows(hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0)) == []
    assert got(spark, [(50, [1.0], 1), (1, [1.0], 2)]) == [] and got(spark, [(50, [1.0], None), (1, None, 2)]) == []


@pytest.mark.parametrize("whole", [False, True])
def test_scans_lose_no_row_that_reaches_the_threshold(monkeypatch, whole):
    monkeypatch.setattr(module, "BUCKET_ROWS", 100)
    draw = np.random.default_rng(8)
    values = draw.integers(-20, 21, (1_000, 10)) * draw.integers(0, 4, (1_000, 1)) * (2**24 if whole else 1)
    index = Shard(values)
    spared = 0
    for anchor in values[::40]:
        scores = values @ anchor
        for threshold in (None, -5, 0, 1, *np.quantile(scores, [0.6, 0.95, 0.999]).astype(int).tolist(), int(scores.max())):
            seen = {p: s for at, score in index.scan(anchor, lambda: threshold) for p, s in zip(at.tolist(), score.tolist())}
            assert all(scores[p] == s for p, s in seen.items())
            reaching = range(1_000) if threshold is None else np.flatnonzero(scores >= threshold).tolist()
            assert set(reaching) <= set(seen)
            spared += 1_000 - len(seen)
    assert spared > 50_000


def test_focus_coordinates_cut_candidates():
    """Near copies of a direction among others: ranges of four coordinates leave few rows to verify."""
    draw = np.random.default_rng(9)
    centers = draw.normal(size=(40, 16))
    centers *= 400 / np.sqrt((centers**2).sum(axis=1))[:, None]
    values = (centers[draw.integers(0, 40, 2_000)] + draw.normal(size=(2_000, 16)) * 8).astype(np.int64)
    scores = values @ values[0]
    threshold = int(0.9 * scores[0])
    seen = sum(len(at) for at, _ in Shard(values).scan(values[0], lambda: threshold))
    assert (scores >= threshold).sum() <= seen < 500
