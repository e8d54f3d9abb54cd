"""Hard negatives by coordinate pruning over buckets of vectors of like length.

A shard's vectors are sorted by length and cut into buckets. For a threshold t a bucket whose longest
vector has length l can only hold rows that see the anchor under a cosine of at least
t / (|anchor| * l). Seen from coordinate f, under which the anchor has the angle a, such a row has an
angle between a - b and a + b, with b that cosine's angle: a range of its coordinate. Each bucket
keeps its coordinates sorted, so a range is a slice; the slices of the anchor's largest coordinates
are intersected, and what is left is verified by whole scores. As results come in the threshold
rises, ranges shrink and short buckets drop out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestrata.llm.vectors import SCALE, exact_type, in_key_order, matrix, over_grid, stored_vectors
from lakestrata.session import new_scratch

BUCKET_ROWS = 2_048
FOCUS = 4
SLACK = 1e-9

POSITIVES = "anchor_row long, row long, vec_id long, score long"
NEGATIVES = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, vec_id long, score long"


class Bucket:
    """Vectors of like length; ``places`` are their places in the shard, in ascending order."""

    def __init__(self, places: np.ndarray, values: np.ndarray, lengths: np.ndarray):
        self.places, self.values, self.longest = places, values, float(lengths.max(initial=0.0))
        self.lengths = lengths
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _sorted(self, coordinate: int) -> tuple[np.ndarray, np.ndarray]:
        """The bucket's rows by a coordinate of their direction, and those coordinates."""
        if coordinate not in self.lists:
            with np.errstate(divide="ignore", invalid="ignore"):
                part = np.nan_to_num(self.values[:, coordinate].astype(float) / self.lengths)
            order = np.argsort(part, kind="stable")
            self.lists[coordinate] = order, part[order]
        return self.lists[coordinate]

    def candidates(self, direction: np.ndarray, length: float, threshold: float | None) -> np.ndarray | None:
        """Rows of the bucket that can reach ``threshold``; None if it excludes nothing."""
        if threshold is None or threshold <= 0:
            return None
        reach = length * self.longest
        if threshold > reach * (1 + SLACK):
            return np.zeros(0, np.int64)
        wide = np.arccos(min(threshold / reach * (1 - SLACK), 1.0))
        hits, used = None, 0
        for f in np.argsort(-np.abs(direction), kind="stable")[:FOCUS]:
            angle = np.arccos(np.clip(direction[f], -1, 1))
            low = np.cos(min(angle + wide, np.pi)) - SLACK
            high = np.cos(max(angle - wide, 0.0)) + SLACK
            order, parts = self._sorted(int(f))
            a, b = np.searchsorted(parts, low, "left"), np.searchsorted(parts, high, "right")
            if b - a == len(order):
                continue
            hits = np.zeros(len(order), np.int8) if hits is None else hits
            hits[order[a:b]] += 1
            used += 1
        return None if hits is None else np.flatnonzero(hits == used)


class Shard:
    """Buckets in descending order of length, over rows in key order."""

    def __init__(self, values: np.ndarray):
        lengths = np.sqrt((values.astype(float) ** 2).sum(axis=1))
        self.kind = exact_type(float(lengths.max(initial=0.0)))
        order = np.argsort(-lengths, kind="stable")
        self.buckets = []
        for a in range(0, len(order), BUCKET_ROWS):
            places = np.sort(order[a : a + BUCKET_ROWS])
            self.buckets.append(Bucket(places, values[places].astype(self.kind), lengths[places]))

    def scan(self, anchor: np.ndarray, threshold: Callable[[], float | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and whole scores of the rows that can reach ``threshold()``, bucket by bucket.

        It is asked again for every bucket, and may only rise.
        """
        length = float(np.sqrt((anchor.astype(float) ** 2).sum()))
        direction = anchor / length if length else anchor.astype(float)
        kind = np.int64 if exact_type(length) is np.int64 else self.kind
        for bucket in self.buckets:
            some = bucket.candidates(direction, length, threshold())
            values, places = bucket.values, bucket.places
            if some is not None:
                if not len(some):
                    continue
                values, places = values[some], places[some]
            yield places, (values.astype(kind, copy=False) @ anchor.astype(kind)).astype(np.int64)


class _Best:
    """The ``k`` highest scores met; of equal scores the first places."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.places, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, places: np.ndarray, scores: np.ndarray) -> None:
        fits = np.ones(len(scores), bool)
        if self.low is not None:
            fits &= (scores >= self.low) & (scores <= self.high)
        if len(self.scores) == self.k:
            fits &= scores >= self.scores[-1]
        places, scores = np.append(self.places, places[fits]), np.append(self.scores, scores[fits])
        if len(scores) > self.k:
            cut = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            places, scores = places[scores >= cut], scores[scores >= cut]
        order = np.lexsort((places, -scores))[: self.k]
        self.places, self.scores = places[order], scores[order]

    def threshold(self) -> float | None:
        """The least score that still can come in."""
        known = [x for x in (self.low, int(self.scores[-1]) if len(self.scores) == self.k else None) if x is not None]
        return max(known) if known else None


def _least(bests: list[_Best]) -> float | None:
    known = [b.threshold() for b in bests]
    return None if None in known else min(known)


def _labels(table: pa.Table) -> np.ndarray:
    return table["label"].to_numpy().astype(np.int64)


def _positives(k: int):
    def run(shard: pa.Table, block: pa.Table, width: int) -> pa.Table:
        shard = in_key_order(shard, "id")
        index, labels = Shard(matrix(shard["values"], width)), _labels(shard)
        where = {row: place for place, row in enumerate(shard["row"].to_pylist())}
        places, scores, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
        for i, (row, label, anchor) in enumerate(zip(block["row"].to_pylist(), _labels(block), matrix(block["values"], width))):
            best, own = _Best(k), where.get(row, -1)
            for at, score in index.scan(anchor, best.threshold):
                alike = (labels[at] == label) & (at != own)
                best.add(at[alike], score[alike])
            places.append(best.places)
            scores.append(best.scores)
            of += [i] * len(best.places)
        found, of = pa.array(np.concatenate(places)), pa.array(of, pa.int64())
        columns = [block["row"].take(of), shard["row"].take(found), shard["id"].take(found), pa.array(np.concatenate(scores))]
        return pa.table(columns, ["anchor_row", "row", "vec_id", "score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(shard: pa.Table, block: pa.Table, width: int) -> pa.Table:
        shard = in_key_order(shard, "id")
        index, labels = Shard(matrix(shard["values"], width)), _labels(shard)
        out = []
        anchors = zip(block["row"].to_pylist(), block["id"].to_pylist(), _labels(block), matrix(block["values"], width), block["positives"].to_pylist())
        for row, key, label, anchor, positives in anchors:
            windows = [(p, _Best(k, -(-low * p["score"] // 100), high * p["score"] // 100)) for p in positives]
            bests = [b for _, b in windows if b.low <= b.high]
            if not bests:
                continue
            for at, score in index.scan(anchor, lambda: _least(bests)):
                other = labels[at] != label
                at, score = at[other], score[other]
                for best in bests:
                    best.add(at, score)
            for p, best in windows:
                out += [(row, key, p["row"], p["vec_id"], p["score"], place, score) for place, score in zip(best.places.tolist(), best.scores.tolist())]
        columns = [pa.array([o[j] for o in out], pa.int64()) for j in range(7)]
        found = columns[5]
        columns[5:6] = [shard["row"].take(found), shard["id"].take(found)]
        return pa.table(columns, [c.split()[0] for c in NEGATIVES.split(", ")])

    return run


def _first(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group by score, key and row, with their rank; a map task sends k of a group at most."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Scores are inner products of ``floor(scale * component)``, exact; higher ones come first, of equal
    ones the smaller key, a NULL key last. An anchor (a row with ``anchors``; NULL is none) has its
    first ``positives`` other rows of the same label as positives. For each, the first ``negatives``
    rows of other labels are returned whose score is ``low`` to ``high`` hundredths of the positive's.
    That window is empty for positives with a score below 0.

    Rows with a NULL label take no part, nor do vectors that are NULL, hold a NULL or non-finite
    component, or whose squares sum to 2**60 or more; shorter vectors count as filled up with zeros.
    Rows that repeat a key, or a whole row, are rows of their own. Anchors without positives, and
    positives without such negatives, have no rows; neither has an empty table.

    Both searches go over the same grid of shards; shards answer with their first rows, which meet
    in one ranking. No label or copy is a group of its own, so none can be hot.
    """
    label = F.col("label") if label is None else label
    columns = {"id": F.col(key).cast("long"), "label": label.cast("long"), "anchor": F.coalesce(anchors, F.lit(False))}
    held = stored_vectors(vectors, vector, columns, label.isNotNull(), scale)
    rows, asked = held.drop("anchor"), held.filter("anchor").drop("anchor")
    path = new_scratch(vectors.sparkSession, "positives")
    alike = _first(over_grid(rows, asked, _positives(positives), POSITIVES), ["anchor_row"], positives)
    # at most ``positives`` structs an anchor
    by_anchor = alike.groupBy("anchor_row").agg(F.sort_array(F.collect_list(F.struct("rank", "row", "vec_id", "score"))).alias("positives"))
    with_positives = asked.join(by_anchor, asked["row"] == by_anchor["anchor_row"]).drop("anchor_row")
    with_positives.write.parquet(path)
    stored = vectors.sparkSession.read.schema(with_positives.schema).parquet(path)
    found = over_grid(rows, stored, _negatives(negatives, low, high), NEGATIVES)
    return _first(found, ["anchor_row", "positive_row"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
