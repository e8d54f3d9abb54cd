import zlib

import numpy as np
import pyarrow as pa

from lakestrata.llm import quality_classifier as qc
from lakestrata.llm.queries import op3_quality_classifier
from tests.conftest import SF
from tests.llm.helpers import AWKWARD, documents, prose, rows


def test_held_out_accuracy(spark):
    scored = op3_quality_classifier(spark, SF)
    got = {r["doc_id"]: r for r in rows(scored)}
    labels = {r["doc_id"]: r["quality"] for r in rows(spark.read.parquet(f"{SF}/labels.parquet"))}
    assert len(got) == 1_000
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(got[i]["score"], y) for i, y in labels.items() if i in got and got[i]["held_out"]]
    good, bad = ([s for s, y in held if y == k] for k in (1, 0))
    wins = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert wins > 0.97


def test_fourier_features_approximate_the_kernel():
    rows_in = np.random.RandomState(1).normal(size=(30, 5))
    z = qc.fourier(rows_in, 20_000)[:, :-1]
    gaps = ((rows_in[:, None] - rows_in[None]) ** 2).sum(2)
    assert np.abs(z @ z.T - np.exp(-gaps / (2 * qc.WIDTH**2))).max() < 0.05


def test_isotonic_is_the_best_rising_fit():
    x, y = np.arange(6.0), np.array([0, 2, 1, 1, 4, 3.0])
    knots, levels = qc.isotonic(x, y, np.ones(6))
    assert np.allclose(levels, [0, 4 / 3, 3.5]) and np.allclose(knots, [0, 2, 4.5])


def test_partition_sums_equal_one_pass(spark):
    values = [([float(i), float(i % 7)], i % 2 * 1.0) for i in range(500)]
    df = spark.createDataFrame(values, "statistics array<float>, label double").repartition(13)
    got = qc._partition_sums(df, lambda x, y: np.concatenate([(x.T @ x).ravel(), x.T @ y]))
    x, y = np.array([v for v, _ in values]), np.array([v for _, v in values])
    assert np.allclose(got, np.concatenate([(x.T @ x).ravel(), x.T @ y]))


def test_awkward_texts_and_labels(spark):
    docs = documents(spark, AWKWARD + [(100 + i, prose(i, 40) if i % 2 else "# " * 40) for i in range(60)])
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(60)] + [(None, 1), (1, None), (9_999, 0), (101, 1)], "doc_id long, quality long")
    got = rows(qc.score_documents(docs, labels))
    assert len(got) == len(AWKWARD) + 60 and all(0 <= r["score"] <= 1 for r in got)
    twins = {r["score"] for r in got if r["doc_id"] == 7}
    assert len(twins) == 1
    kept = qc.keep_good(docs.withColumnRenamed("source", "score"), labels)
    assert kept.columns == ["doc_id", "text", "lang", "score", "n_chars"]
    want = sorted(str(r["doc_id"]) for r in got if r["score"] >= 0.3)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality long")
    assert {r["score"] for r in rows(qc.score_documents(documents(spark, AWKWARD), labels))} == {0.5}
    assert rows(qc.score_documents(documents(spark, {}), labels)) == []


def test_statistics_ignore_batch_borders():
    texts = [t for _, t in AWKWARD]
    whole = qc.statistics(pa.array(texts, pa.string()))
    alone = np.concatenate([qc.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, alone) and whole.shape == (len(texts), qc.N_STATISTICS)
