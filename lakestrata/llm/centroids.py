"""Centroid clustering that skips distances by bounds, loosened by planar geometry.

Every vector keeps an upper bound of the distance to its centroid and a lower bound of that to any
other. When centroid j moves from a to b by p, the lower bounds of cluster i need not fall by p: all
members lie in the sphere of radius m around their old centroid c, and in the plane through c, a
and b a point seen from the middle of a and b at an angle t to the way from a to b has come nearer
by at most p * cos(t). With t the least angle under which the sphere is seen, that bounds the loss
for the whole cluster. Vectors whose bounds cross are measured exactly.

Why: |x - a|^2 - |x - b|^2 = 2 * p * s, where s is how far x lies along the way, from the middle;
and |x - a| + |x - b| >= 2 * r, where r is its distance from the middle. So the difference of both
distances is at most p * s / r = p * cos(t).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.vectors import SCALE, exact_type, matrix, stored_vectors
from lakestrata.session import new_scratch
from lakestrata.sources import fs

#: far above the rounding of a few sums of doubles, far below what a skipped vector could gain
SLACK = 1e-7

STATE = (
    "row long, id long, values array<int>, cluster int, upper double, lower double, distance long, "
    "members long, measured long, total array<long>"
)


def distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances as whole numbers, points x centers."""
    p2, c2 = (points * points).sum(axis=1), (centers * centers).sum(axis=1)
    kind = exact_type(float(p2.max(initial=0)) ** 0.5, float(c2.max(initial=0)) ** 0.5)
    inner = (points.astype(kind) @ centers.T.astype(kind)).astype(np.int64)
    return p2[:, None] - 2 * inner + c2


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Per cluster the most by which any other centroid's way can have brought it nearer to a member."""
    a, b, m = old.astype(float), new.astype(float), radius
    way = b - a
    p = np.sqrt((way * way).sum(axis=1))
    away = a[:, None, :] - ((a + b) / 2)[None, :, :]
    r = np.sqrt((away * away).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip((away * way).sum(axis=2) / (r * p), -1, 1))
        spread = np.arcsin(np.clip(m[:, None] / r, -1, 1))
        nearer = p * np.cos(np.clip(angle - spread, 0, np.pi / 2))
    nearer = np.where(m[:, None] >= r, p, nearer)
    nearer = np.where(p > 0, nearer * (1 + SLACK) + SLACK, 0.0)
    np.fill_diagonal(nearer, 0.0)
    return nearer.max(axis=1, initial=0.0)


def _measured(points: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest center (of equally near ones the first), the distance to it and to the next."""
    d = distances(points, centers)
    cluster = d.argmin(axis=1)
    rows = np.arange(len(points))
    upper = np.sqrt(d[rows, cluster].astype(float))
    d[rows, cluster] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(float)) if len(centers) > 1 else np.full(len(points), np.inf)
    return cluster, upper, lower


def _assigned(centers: np.ndarray, moved: np.ndarray | None, loosened: np.ndarray | None):
    """One round over rows of ``STATE``: vectors with their new state, then the task's sums per cluster."""
    k, width = centers.shape

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        radius, measured, inertia = np.zeros(k), 0, np.zeros(k, np.int64)
        for batch in batches:
            points = matrix(batch.column("values"), width)
            if moved is None:
                cluster, upper, lower = _measured(points, centers)
                measured += len(points)
            else:
                cluster = np.asarray(batch.column("cluster")).astype(np.int64)
                upper = np.asarray(batch.column("upper")) + moved[cluster]
                lower = np.asarray(batch.column("lower")) - loosened[cluster]
                open_ = np.flatnonzero(upper + SLACK >= lower)
                apart = points[open_] - centers[cluster[open_]]
                upper[open_] = np.sqrt((apart * apart).sum(axis=1).astype(float))
                open_ = open_[upper[open_] + SLACK >= lower[open_]]
                cluster[open_], upper[open_], lower[open_] = _measured(points[open_], centers)
                measured += len(open_)
            apart = points - centers[cluster]
            distance = (apart * apart).sum(axis=1)
            np.add.at(total, cluster, points)
            np.add.at(inertia, cluster, distance)
            members += np.bincount(cluster, minlength=k)
            np.maximum.at(radius, cluster, upper)
            yield _batch(
                len(points),
                row=batch.column("row"), id=batch.column("id"), values=batch.column("values"),
                cluster=cluster.astype(np.int32), upper=upper, lower=lower, distance=distance,
            )
        held = np.flatnonzero(members)
        if len(held):
            spent = np.zeros(len(held), np.int64)
            spent[0] = measured
            offsets = pa.array(np.arange(len(held) + 1, dtype=np.int32) * width)
            yield _batch(
                len(held),
                cluster=held.astype(np.int32), upper=radius[held], distance=inertia[held], members=members[held], measured=spent,
                total=pa.ListArray.from_arrays(offsets, pa.array(total[held].ravel())),
            )

    return run


_KINDS = {
    "row": pa.int64(), "id": pa.int64(), "values": pa.list_(pa.int32()), "cluster": pa.int32(), "upper": pa.float64(),
    "lower": pa.float64(), "distance": pa.int64(), "members": pa.int64(), "measured": pa.int64(), "total": pa.list_(pa.int64()),
}


def _batch(rows: int, **columns) -> pa.RecordBatch:
    """A batch of ``STATE``; columns that are not given are NULL."""
    arrays = [pa.nulls(rows, kind) if name not in columns else pa.array(columns[name]).cast(kind) for name, kind in _KINDS.items()]
    return pa.RecordBatch.from_arrays(arrays, list(_KINDS))


def _sums(state: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Component sums (exact), members, radius and inertia of each cluster, and how many vectors were
    measured against all centroids. Only k * width sums reach the driver."""
    tasks = state.filter("total is not null")
    totals, members, radius, inertia, measured = np.zeros((k, width), object), np.zeros(k, object), np.zeros(k), np.zeros(k, object), 0
    of_cluster = (F.sum("members").alias("n"), F.max("upper").alias("r"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.sum("measured").alias("m"))
    for row in tasks.groupBy("cluster").agg(*of_cluster).collect():
        c = row["cluster"]
        members[c], radius[c], inertia[c] = row["n"], row["r"], int(row["d"])
        measured += row["m"]
    parts = tasks.select("cluster", F.posexplode("total").alias("place", "part"))
    for row in parts.groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect():
        totals[row["cluster"], row["place"]] = int(row["part"])
    return totals, members, radius, inertia, measured


def cluster_vectors(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    seed: int = 2,
    width: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    measured: list[int] | None = None,
) -> DataFrame:
    """``(key, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every usable vector.

    Vectors have exactly ``width`` components, none NULL or non-finite, and become whole numbers
    ``floor(scale * x)``; others are left out, as are those whose squares sum to 2**60 or more. The
    first centroids are the k vectors with the least sha256 of ``seed:key``; a NULL key counts after
    all others, repeated keys by their values. Each round assigns every vector to its nearest
    centroid (equally near: the smaller number) and moves each centroid to the floor of its members'
    mean; one without members stays. Then vectors are assigned once more. Fewer than k vectors make
    as many centroids; an empty table has no rows to return. Repeated rows are rows of their own.

    A round is one pass without a shuffle: it reads the last round's vectors and bounds, writes the
    new ones to the scratch folder, and leaves k sums per task to add up. A lost executor costs its
    tasks of one round. ``measured``, if given, gets the number of vectors that each assignment held
    against all centroids.
    """
    spark = vectors.sparkSession
    held = stored_vectors(vectors, vector, {"id": F.col(key).cast("long")}, F.size(vector) == width, scale)
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = held.select(rank.alias("rank"), "values").orderBy(F.asc_nulls_last("rank"), "values").limit(k).collect()
    centers = np.array([r["values"] for r in first], np.int64).reshape(len(first), width)
    state = held.selectExpr("row", "id", "values", "cast(null as int) cluster", "cast(null as double) upper", "cast(null as double) lower")
    moved = loosened = last = None
    for n in range(rounds + 1):
        path = new_scratch(spark, "clusters")
        # without centroids there are no vectors either
        state.mapInArrow(_assigned(centers, moved, loosened), STATE).write.parquet(path)
        stored = spark.read.schema(STATE).parquet(path)
        if last:
            fs.delete(spark, last)
        last = path
        state = stored.filter("total is null").select("row", "id", "values", "cluster", "upper", "lower")
        totals, members, radius, inertia, spent = _sums(stored, len(centers), width)
        if measured is not None:
            measured.append(spent)
        if n < rounds:
            new = centers.copy()
            for c in np.flatnonzero(members):
                new[c] = [t // members[c] for t in totals[c]]
            moved = np.sqrt(((new - centers).astype(float) ** 2).sum(axis=1)) * (1 + SLACK)
            loosened = loosening(centers, new, radius)
            centers = new
    placed = stored.filter("total is null").select(F.col("id").alias(key), "cluster", "distance")
    digests = [hashlib.sha256(",".join(map(str, v.tolist())).encode()).hexdigest() for v in centers]
    whole = sum(inertia)
    # k rows
    summary = spark.createDataFrame(
        [(c, inertia[c], whole, digest) for c, digest in enumerate(digests)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return placed.join(F.broadcast(summary), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
