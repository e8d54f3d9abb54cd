import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import top_k as module
from lakestrata.llm import vectors as grid
from lakestrata.llm.top_k import Postings, top_k
from tests.llm.helpers import ODD_VECTORS, VECTORS, drawn_vectors, inner, rows, vectors, whole_numbers


def expected(items, k):
    kept = whole_numbers(items)
    found = []
    for n, (key, a, _) in enumerate(kept):
        if key is None or key % 50:
            continue
        others = sorted((-inner(a, b), i is None, i or 0) for m, (i, b, _) in enumerate(kept) if m != n)
        found += [(key, r, None if none else i, -s) for r, (s, none, i) in enumerate(others[:k], 1)]
    return sorted(found, key=str)


def got(spark, items, k):
    made = rows(top_k(vectors(spark, items), F.col("vec_id") % 50 == 0, k))
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in made), key=str)


@pytest.mark.parametrize("k", [1, 5, 100])
def test_odd_vectors(spark, k):
    assert got(spark, ODD_VECTORS, k) == expected(ODD_VECTORS, k)


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(grid, "BLOCK_BYTES", 6 * 8 * 40)
    items = drawn_vectors(1, 900, 6) + [(i, [1.0, -1.0, 0.5, 0.0, 0.0, 0.0], 0) for i in range(1_000, 1_400)]
    assert got(spark, items, 5) == expected(items, 5)


def test_empty_tables(spark):
    assert rows(top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 50 == 0)) == []
    assert got(spark, [(50, None, 1), (None, [1.0], 1)], 5) == [] and got(spark, [(50, [1.0], 1)], 5) == []


def test_large_components_stay_exact(spark):
    items = [(50, [2.0**19, 3.0], 0), (1, [2.0**19, 1.0], 0), (2, [2.0**19, 2.0], 0)]
    assert got(spark, items, 2) == expected(items, 2)


@pytest.mark.parametrize("kind", ["dense", "sparse", "clustered"])
def test_windows_give_the_same_as_all_scores(monkeypatch, kind):
    monkeypatch.setattr(module, "WINDOW_ROWS", 64)
    draw = np.random.default_rng(3)
    values = draw.integers(-40, 41, (1_000, 30))
    if kind == "sparse":
        values *= draw.random((1_000, 30)) < 0.1
    if kind == "clustered":
        values = values // 8 + 60 * draw.integers(-1, 2, (5, 30))[draw.integers(0, 5, 1_000)]
    index = Postings(values)
    for own in range(0, 1_000, 37):
        places, scores = index.top(values[own], 5, own)
        whole = values @ values[own]
        whole[own] = -(2**62)
        order = np.argsort(-whole, kind="stable")[:5]
        assert places.tolist() == order.tolist() and scores.tolist() == whole[order].tolist()


def test_non_essential_terms_are_only_probed(monkeypatch):
    """Rare heavy terms decide: lists of the common light ones are never traversed after the first window."""
    monkeypatch.setattr(module, "WINDOW_ROWS", 100)
    values = np.zeros((5_000, 12), np.int64)
    values[:, :10] = 1
    values[::50, 10] = 900
    values[::70, 11] = 800
    index, traversed = Postings(values), []
    gather = Postings._gather
    monkeypatch.setattr(Postings, "_gather", lambda self, term, *rest: (traversed.append(term), gather(self, term, *rest)))
    places, _ = index.top(np.ones(12, np.int64), 5)
    assert places.tolist() == [0, 350, 700, 1_050, 1_400]
    # the ten of the first window, and one more while the fifth best scores no more than all of them together
    assert sum(t < 10 for t in traversed) == 11 and sum(t >= 10 for t in traversed) > 50
