"""Exact top-k search by MaxScore over shards of postings.

A component is a term, a vector a document. A query's terms are ordered by the most that each can
add to a score. Those whose bounds together can't reach the score of the k-th best document so far
are non-essential: a document without an essential term can't compete. The postings of essential
terms are traversed, window by window; the others are only probed for documents that still can
reach the threshold. A higher threshold makes more terms non-essential in the next window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.vectors import SCALE, in_key_order, matrix, over_grid, stored_vectors

WINDOW_ROWS = 8_192
FOUND = "query_row long, query_id long, row long, vec_id long, score long"


class Postings:
    """One shard: per term the places of the documents that hold it, and weights by place."""

    def __init__(self, values: np.ndarray):
        self.size = len(values)
        self.weights = np.ascontiguousarray(values.T)
        self.places = [np.flatnonzero(w) for w in self.weights]
        self.low = np.minimum(values.min(axis=0, initial=0), 0)
        self.high = np.maximum(values.max(axis=0, initial=0), 0)

    def _gather(self, term: int, weight: int, first: int, end: int, sums: np.ndarray) -> None:
        """Add a term's part to the sums of the documents ``first`` to ``end - 1``."""
        places = self.places[term]
        if 2 * len(places) > self.size:  # a list that most documents are on is read with its gaps
            sums += weight * self.weights[term, first:end]
        else:
            places = places[np.searchsorted(places, first) : np.searchsorted(places, end)]
            sums[places - first] += weight * self.weights[term, places]

    def top(self, query: np.ndarray, k: int, own: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents but ``own``; of equal scores the first places."""
        bounds = np.maximum(query * self.high, query * self.low)
        terms = np.argsort(-bounds, kind="stable")
        terms = terms[query[terms] != 0]
        # the most that the terms from j on can add, and 0 after the last
        rest = np.append(np.cumsum(bounds[terms][::-1])[::-1], 0)
        places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = None
        for first in range(0, self.size, WINDOW_ROWS):
            end = min(first + WINDOW_ROWS, self.size)
            essential = len(terms) if least is None else int(np.searchsorted(-rest, -least, side="right"))
            if least is not None and essential == 0:
                break  # all terms together don't reach it
            essential = min(essential, len(terms))
            sums = np.zeros(end - first, np.int64)
            for term in terms[:essential]:
                self._gather(term, query[term], first, end, sums)
            alive = np.ones(end - first, bool) if least is None else sums + rest[essential] >= least
            if first <= own < end:
                alive[own - first] = False
            alive = np.flatnonzero(alive)
            sums = sums[alive]
            if len(alive) > k and essential < len(terms):
                # the whole scores of the most promising ones may raise the threshold
                ahead = first + alive[np.argpartition(-sums, k - 1)[:k]]
                least = max(least, int((query @ self.weights[:, ahead]).min()))
            for j in range(essential, len(terms)):
                competitive = sums + rest[j] >= least
                alive, sums = alive[competitive], sums[competitive]
                if not len(alive):
                    break
                sums = sums + query[terms[j]] * self.weights[terms[j], first + alive]
            places, scores = np.append(places, first + alive), np.append(scores, sums)
            if len(scores) > k:
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = np.flatnonzero(scores >= cut)
                near = near[np.argsort(-scores[near], kind="stable")[:k]]
                places, scores = places[near], scores[near]
            if len(scores) == k:
                least = int(scores.min())
        order = np.lexsort((places, -scores))
        return places[order], scores[order]


def _search(k: int):
    def run(shard: pa.Table, block: pa.Table, width: int) -> pa.Table:
        shard = in_key_order(shard, "id")
        postings = Postings(matrix(shard["values"], width))
        where = {row: place for place, row in enumerate(shard["row"].to_pylist())}
        rows, ids = shard["row"].to_numpy(), shard["id"]
        asked = block["row"].to_pylist()
        found = [postings.top(q, k, where.get(row, -1)) for row, q in zip(asked, matrix(block["values"], width))]
        counts = [len(places) for places, _ in found]
        places = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in found)])
        of = np.repeat(np.arange(len(found)), counts)
        return pa.table(
            {
                "query_row": block["row"].take(pa.array(of)),
                "query_id": block["id"].take(pa.array(of)),
                "row": pa.array(rows[places], pa.int64()),
                "vec_id": ids.take(pa.array(places)),
                "score": np.concatenate([np.zeros(0, np.int64), *(s for _, s in found)]),
            }
        )

    return run


def top_k(vectors: DataFrame, asked: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row with ``asked`` the k other rows with the
    highest inner product of ``floor(scale * component)``, exactly; all of them where there are fewer.

    Of equal scores the smaller key comes first, a NULL key last. Vectors that are NULL or hold a
    NULL or non-finite component take no part, nor do those whose squares sum to 2**60 or more;
    shorter vectors count as filled up with zeros. Rows that repeat a key, or a whole row, are rows
    of their own: each asks, and each is found by the others. A row where ``asked`` is NULL doesn't
    ask. An empty table has no rows to return.

    Every shard answers every query with its k best; the answers meet in one ranking per query,
    of which each map task sends k rows at most.
    """
    held = stored_vectors(vectors, vector, {"id": F.col(key).cast("long"), "asked": F.coalesce(asked, F.lit(False))}, F.lit(True), scale)
    columns = ["row", "id", "values"]
    found = over_grid(held.select(*columns), held.filter("asked").select(*columns), _search(k), FOUND)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
