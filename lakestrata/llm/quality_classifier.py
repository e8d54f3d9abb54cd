"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.words import shingle_hashes, slices, text_bytes, word_hashes, word_spans
from lakestrata.session import new_scratch

FEATURES = 256
WIDTH = 3.0
RIDGE = 1.0
SEED = 20
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
ACCEPT = 0.3
BINS = 2_000
SUM_GROUPS = 32
WINDOW_WORDS = 3


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars.encode())] = 1
    return table


UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
CLASSES = (
    UPPER,
    _class("abcdefghijklmnopqrstuvwxyz"),
    _class("0123456789"),
    _class(" \t\r\v\f"),
    _class("\n"),
    _class(".,;:'\"()-?"),
    _class("!"),
    _class("|"),
    _class("#*$%&<>"),
    _class("/@=_\\{}[]^~`+"),
    (np.arange(256) >= 0x80).astype(np.uint8),
)
N_STATISTICS = len(CLASSES) + 11


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of rows that may be empty."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of numbers per text, whole texts only; NULL and empty texts have a row like any."""
    data, offsets = text_bytes(texts)
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1).astype(float)
    columns = [_summed(c[data], offsets) / size for c in CLASSES]
    words, first = word_hashes(data, offsets, fold=True)
    n = np.diff(first)
    many = np.maximum(n, 1).astype(float)
    starts, ends = word_spans(data, offsets)
    length = (ends - starts).astype(float)
    mean = _summed(length, first) / many
    columns += [np.log1p(n), np.log1p(mean), np.sqrt(np.maximum(_summed(length**2, first) / many - mean**2, 0)) / np.maximum(mean, 1)]
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:])], float)
    columns += [distinct / many, distinct / np.sqrt(many)]
    windows, at = shingle_hashes(words, first, WINDOW_WORDS)
    columns.append(np.array([len(np.unique(windows[a:b])) for a, b in zip(at[:-1], at[1:])], float) / np.maximum(np.diff(at), 1))
    same = np.zeros(len(words))
    same[1:] = words[1:] == words[:-1]
    same[first[:-1][n > 0]] = 0
    columns.append(_summed(same, first) / many)
    shouted = UPPER[data[starts]] * UPPER[data[ends - 1 - (ends - starts > 1)]] if len(words) else np.zeros(0)
    columns.append(_summed(shouted.astype(float), first) / many)
    lines = _summed((data == 0x0A).astype(float), offsets) + 1
    columns += [np.log1p(lines), np.log1p(n / lines), _repeated_lines(data, offsets, rows)]
    return np.stack(columns, axis=1)


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, rows: int) -> np.ndarray:
    """Share of a text's words that stand in a line equal to an earlier one."""
    shares = np.zeros(rows)
    breaks = np.flatnonzero(data == 0x0A)
    edges = np.searchsorted(breaks, offsets)
    for row in np.flatnonzero(np.diff(edges) > 0):
        ends = np.append(breaks[edges[row] : edges[row + 1]], offsets[row + 1])
        begins = np.append(offsets[row], ends[:-1] + 1)
        seen, again = set(), 0
        for a, b in zip(begins.tolist(), ends.tolist()):
            line = data[a:b].tobytes()
            again += (b - a) * (line in seen)
            seen.add(line)
        shares[row] = again / max(offsets[row + 1] - offsets[row], 1)
    return shares


class Model(NamedTuple):
    """Scores statistics; ``center`` and ``scale`` standardise, ``knots`` calibrate."""

    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return fourier((rows - self.center) / self.scale, len(self.weights) - 1) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The calibrated chance of a good text, 0 to 1."""
        return np.clip(np.interp(self.raw(rows), self.knots, self.levels), 0.0, 1.0)


def fourier(rows: np.ndarray, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> np.ndarray:
    """Inner products of these approximate exp(-|x - y|**2 / (2 width**2)); the last column is 1.

    Far outliers are drawn in to eight deviations, so none loses all likeness to others.
    """
    draw = np.random.RandomState(seed)
    directions = draw.normal(size=(rows.shape[1], features)) / width
    phases = draw.uniform(0, 2 * np.pi, features)
    waves = np.cos(np.clip(rows, -8, 8) @ directions + phases) * np.sqrt(2 / features)
    return np.concatenate([waves, np.ones((len(rows), 1))], axis=1)


def isotonic(position: np.ndarray, hits: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the best rising fit (pool adjacent violators), from ascending bins.

    Each pool becomes one knot at its mean position, so scores rise between pools as well.
    """
    pools: list[list[float]] = []
    for x, h, n in zip(position.tolist(), hits.tolist(), count.tolist()):
        pools.append([x * n, h, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def statistics_table(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(_key, statistics)`` of every text, written once to the shared scratch folder."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows = statistics(batch.column("_text")).astype(np.float32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_STATISTICS)
                yield pa.RecordBatch.from_arrays([batch.column("_key"), flat.cast(pa.list_(pa.float32()))], ["_key", "statistics"])

    spark = documents.sparkSession
    schema = T.StructType([T.StructField("_key", documents.schema[key].dataType), T.StructField("statistics", T.ArrayType(T.FloatType()))])
    path = new_scratch(spark, "statistics")
    documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(run, schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fold_of(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.values if column.offset == 0 else column.flatten(), float).reshape(len(column), -1)


def _partition_sums(rows: DataFrame, moments) -> np.ndarray:
    """The sum over all rows of an array that ``moments(statistics, labels)`` gives per batch.

    Tasks send one array each; those are added in groups, then the groups' sums, of which there are
    ``SUM_GROUPS`` at most; one array reaches the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            if batch.num_rows:
                total = total + moments(_matrix(batch.column("statistics")), np.asarray(batch.column("label"), float))
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s) for s in frame["sums"])
        return pd.DataFrame({"sums": [total.tobytes()]})

    sums = rows.select("statistics", "label").mapInArrow(run, "sums binary")
    grouped = sums.groupBy(F.spark_partition_id() % SUM_GROUPS).applyInPandas(add, "sums binary")
    found = grouped.groupBy().applyInPandas(add, "sums binary").collect()
    return np.frombuffer(found[0]["sums"]) if found else np.zeros(0)


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE) -> Model:
    """A model from ``(_key, statistics, label)`` rows outside the held-out fold.

    One fold calibrates, the others fit. Everything that reaches the driver is of fixed size: the
    sums of two moments per statistic, one ``features`` square matrix, and the calibration bins. Without rows to fit, every score is 0.5; without rows to calibrate, scores are
    the clipped fit.
    """
    fold = fold_of("_key")
    train = labelled.filter((fold != HELD_OUT) & (fold != CALIBRATION))
    sums = _partition_sums(train, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)]))
    flat = Model(np.zeros(N_STATISTICS), np.ones(N_STATISTICS), np.zeros(features + 1), np.array([0.0, 1.0]), np.array([0.5, 0.5]))
    if not len(sums):
        return flat
    center = sums[1 : N_STATISTICS + 1] / sums[0]
    spread = np.sqrt(np.maximum(sums[N_STATISTICS + 1 :] / sums[0] - center**2, 0))
    scale = np.where(spread > 1e-6, spread, 1.0)

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = fourier((x - center) / scale, features)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _partition_sums(train, normal)
    size = features + 1
    penalty = np.full(size, ridge)
    penalty[-1] = 1e-6
    weights = np.linalg.solve(sums[: size * size].reshape(size, size) + np.diag(penalty), sums[size * size :])
    model = Model(center, scale, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch.column("statistics"))), -0.5, 1.5)
            place = np.minimum(((raw + 0.5) / 2 * BINS).astype(np.int64), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(raw), batch.column("label")], ["bin", "raw", "label"])

    held = labelled.filter(fold == CALIBRATION).select("statistics", "label").mapInArrow(bins, "bin long, raw double, label double")
    found = held.groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("label").alias("hits"), F.count(F.lit(1)).alias("n")).toPandas()
    if not len(found):
        return model
    found = found.sort_values("raw")
    knots, levels = isotonic(found["raw"].to_numpy(), found["hits"].to_numpy(), found["n"].to_numpy(float))
    return model._replace(knots=knots, levels=levels)


def labelled_statistics(table: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Statistics with a 0/1 label; other labels, unknown and NULL keys fall out, of a key labelled
    twice the mean counts."""
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("_key")).agg(F.avg(F.col(label)).alias("label"))
    return table.join(known, "_key")


def score_documents(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``(key, held_out, score, predicted)`` for every row of ``documents``.

    Only statistics of the text enter a score. ``held_out`` marks keys of the fold that no fit has
    seen (false for NULL keys, which have no label). Repeated rows are scored alike.
    """
    table = statistics_table(documents, key, text)
    model = fit(labelled_statistics(table, labels, key, label))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(_matrix(batch.column("statistics")))
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(scores)], [key, "score"])

    kind = documents.schema[key].dataType.simpleString()
    scored = table.mapInArrow(run, f"{key} {kind}, score double")
    held_out = F.coalesce(fold_of(key) == HELD_OUT, F.lit(False))
    return scored.select(key, held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def keep_good(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", accept: float = ACCEPT) -> DataFrame:
    """The rows of ``documents`` that score at least ``accept``; same columns.

    Texts are measured twice, to fit and to filter, so that none has to move.
    """
    model = fit(labelled_statistics(statistics_table(documents, key, text), labels, key, label))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                scores = model.score(statistics(batch.column(text)).astype(np.float32).astype(float))
                yield batch.filter(pa.array(scores >= accept))

    return documents.mapInArrow(run, documents.schema)
