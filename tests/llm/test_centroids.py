import hashlib

import numpy as np
import pytest

from lakestrata.llm.centroids import cluster_vectors, distances, loosening
from tests.llm.helpers import ODD_VECTORS, VECTORS, drawn_vectors, rows, vectors, whole_numbers


def expected(items, k, rounds, width, seed=2):
    kept = [(i, v) for i, v, _ in whole_numbers(items) if len(v) == width]
    digest = lambda i: (1, "") if i is None else (0, hashlib.sha256(f"{seed}:{i}".encode()).hexdigest())
    centers = [v for _, v in sorted(kept, key=lambda x: (*digest(x[0]), x[1]))[:k]]
    for n in range(rounds + 1):
        far = [[sum((a - b) ** 2 for a, b in zip(v, c)) for c in centers] for _, v in kept]
        placed = [min(range(len(centers)), key=lambda c: (d[c], c)) for d in far]
        if n < rounds:
            for c in set(placed):
                own = [v for (_, v), p in zip(kept, placed) if p == c]
                centers[c] = [sum(x) // len(own) for x in zip(*own)]
    inertia = [sum(d[p] for d, p in zip(far, placed) if p == c) for c in range(len(centers))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted(((i, p, d[p], inertia[p], sum(inertia), names[p]) for (i, _), p, d in zip(kept, placed, far)), key=str)


def got(spark, items, **how):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r[c] for c in columns) for r in rows(cluster_vectors(vectors(spark, items).repartition(3), **how))), key=str)


@pytest.mark.parametrize("k, rounds", [(1, 2), (4, 3), (40, 2), (3, 0)])
def test_odd_vectors(spark, k, rounds):
    assert got(spark, ODD_VECTORS, k=k, rounds=rounds, width=3) == expected(ODD_VECTORS, k, rounds, 3)


def test_many_vectors_and_copies(spark):
    items = drawn_vectors(4, 500, 5, groups=6) + [(i, [0.5, 0.5, 0.5, 0.5, 0.5], 0) for i in range(600, 900)]
    assert got(spark, items, k=9, rounds=6, width=5) == expected(items, 9, 6, 5)


def test_few_vectors_of_clear_clusters_are_measured_again(spark):
    items = [(i, [x / 10 for x in v], k) for i, v, k in drawn_vectors(4, 600, 5, groups=6)]
    items = [(i, [x + (20.0 if i % 2 else -20.0) for x in v], k) for i, v, k in items]
    measured = []
    assert got(spark, items, k=2, rounds=4, width=5, measured=measured) == expected(items, 2, 4, 5)
    assert measured[0] == 600 and len(measured) == 5 and measured[-1] == 0


def test_empty_tables(spark):
    assert rows(cluster_vectors(spark.createDataFrame([], VECTORS))) == []
    assert got(spark, [(1, None, 0), (2, [1.0], 0)], k=2, rounds=2, width=3) == []


def test_distances_of_large_vectors_are_exact():
    a, b = np.array([[2**29, 1], [0, 0]]), np.array([[2**29 - 1, 0], [-(2**29), 3]])
    assert distances(a, b).tolist() == [[2, 2**60 + 4], [(2**29 - 1) ** 2, 2**58 + 9]]


def test_bounds_are_loosened_enough_and_by_less_than_the_drift():
    draw = np.random.default_rng(5)
    saved = 0
    for _ in range(60):
        old = draw.integers(-300, 300, (6, 4))
        new = old + draw.integers(-40, 41, (6, 4)) * (draw.random((6, 1)) < 0.7)
        radius = draw.random(6) * 250
        loose = loosening(old, new, radius)
        way = np.sqrt(((new - old) ** 2).sum(axis=1).astype(float))
        for i in range(6):
            points = draw.normal(size=(400, 4))
            points *= (radius[i] * draw.random((400, 1)) ** 0.2) / np.sqrt((points**2).sum(axis=1))[:, None]
            points += old[i]
            to = lambda c: np.sqrt(((points[:, None, :] - c[None]) ** 2).sum(axis=2))
            nearer = np.delete(to(old) - to(new), i, axis=1).max()
            assert nearer <= loose[i] + 1e-9
            most = np.delete(way, i).max()
            assert loose[i] <= most * (1 + 1e-6) + 1e-6
            saved += loose[i] < 0.95 * most
    assert saved > 60
