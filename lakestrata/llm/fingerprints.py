"""Document fingerprints: bottom-k sketches of word-shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.llm.words import slices, shingle_sets

SKETCH_SIZE = 128
BUCKETS_PER_PARTITION = 4
RANGE = float(1 << 64)


class Sketch:
    """The ``size`` least of a set of uniform 64-bit hashes; all of them while there are fewer."""

    __slots__ = ("least", "size")

    def __init__(self, hashes: np.ndarray, size: int = SKETCH_SIZE):
        """``hashes`` sorted and distinct."""
        self.least, self.size = hashes[:size], size

    @property
    def whole(self) -> bool:
        """Whether the sketch still is the set itself."""
        return len(self.least) < self.size

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of the union of both sets."""
        return Sketch(np.union1d(self.least, other.least), min(self.size, other.size))

    def count(self) -> float:
        """Distinct shingles: exact while whole, else from the place of the largest kept hash."""
        return float(len(self.least)) if self.whole else (self.size - 1) * RANGE / (float(self.least[-1]) + 1)

    def resemblance(self, other: Sketch) -> float:
        """Shared part of the union, 0 to 1; two empty sets are alike."""
        union = np.union1d(self.least, other.least)
        if not (self.whole and other.whole):
            union = union[: min(self.size, other.size)]
        if not len(union):
            return 1.0
        shared = np.intersect1d(self.least, other.least, assume_unique=True)
        return float(np.count_nonzero(shared <= union[-1])) / len(union)

    def containment(self, other: Sketch) -> float:
        """Part of this set that ``other`` holds; the empty set is held by any."""
        if not len(self.least):
            return 1.0
        joint = self.resemblance(other) * self.merge(other).count()
        return min(1.0, joint / self.count())

    def text(self) -> str:
        return base64.b64encode(self.least.astype(">u8").tobytes()).decode()

    @classmethod
    def read(cls, text: str, size: int = SKETCH_SIZE) -> Sketch:
        return cls(np.frombuffer(base64.b64decode(text), ">u8").astype(np.uint64), size)


def sketches(texts: pa.Array, size: int = SKETCH_SIZE) -> list[Sketch]:
    """One sketch per row; NULL is an empty text."""
    return [Sketch(found, size) for found in shingle_sets(texts, fold=False)]


def fingerprint(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SKETCH_SIZE) -> DataFrame:
    """``(key, fingerprint, shingles)`` of every document; rows with equal keys stay apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                found = sketches(batch.column("_text"), size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key"), pa.array([s.text() for s in found]), pa.array([s.count() for s in found], pa.float64())],
                    [key, "fingerprint", "shingles"],
                )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        run, f"{key} {kind}, fingerprint string, shingles double"
    )



def merge_fingerprints(parts: DataFrame, key: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``(key, fingerprint)``: the sketch of all parts together, from ``(key, fingerprint)`` rows.

    Hashes of all parts are one table; the ``size`` least per key come from a grouped top-k, first
    within slices of a key's parts, so that no task holds all parts of one.
    """
    salted = parts.select(F.col(key), F.col("fingerprint"), (F.monotonically_increasing_id() % 64).alias("_salt"))

    def join(frame):
        found = Sketch(np.zeros(0, np.uint64), size)
        for row in frame["fingerprint"]:
            found = found.merge(Sketch.read(row, size))
        return frame[[key]].head(1).assign(fingerprint=found.text())

    kind = f"{key} {parts.schema[key].dataType.simpleString()}, fingerprint string"
    once = salted.groupBy(key, "_salt").applyInPandas(join, kind)
    return once.groupBy(key).applyInPandas(join, kind)


RESULT = T.StructType(
    [
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
        T.StructField("shingles", T.DoubleType()),
        T.StructField("contained_in_edited", T.DoubleType()),
    ]
)


def _deal(cuts: np.ndarray, nulls: bool):
    """Rows with their range of keys; each range also gets the first row of the one after it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_key")
            absent = np.asarray(keys.is_null())
            values = np.asarray(keys.fill_null(int(cuts[0])))
            bucket = np.where(absent, 1, np.searchsorted(cuts, values, "right")).astype(np.int64)
            heads = (values == cuts[bucket - 1]) & ~absent & (bucket > 1)
            wrap = absent if nulls else (values == cuts[0])
            for rows, to, lent in (
                (np.arange(len(bucket)), bucket, False),
                (np.flatnonzero(heads), bucket[heads] - 1, True),
                (np.flatnonzero(wrap), np.full(wrap.sum(), len(cuts)), True),
            ):
                if len(rows):
                    part = batch.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to, pa.int64()), pa.array(np.full(len(rows), lent)), part.column("_key"), part.column("_text")],
                        ["_bucket", "_lent", "_key", "_text"],
                    )

    return run


def _compare(key: str, size: int):
    """Each row of a sorted range against the row after it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
                held = rows.slice(rows.num_rows - 1)
                lent = np.asarray(rows.column("_lent"))
                of = np.flatnonzero(~lent[:-1])
                if not len(of):
                    continue
                texts = [t or "" for t in rows.column("_text").to_pylist()]
                edited = [texts[i][: len(texts[i]) - len(texts[i]) // 4] + texts[i + 1][: len(texts[i]) // 4] for i in of]
                now = sketches(rows.column("_text"), size)
                then = sketches(pa.array(edited, pa.large_string()), size)
                values = [
                    [len(texts[i]) for i in of],
                    [hashlib.sha256(e.encode()).hexdigest() for e in edited],
                    [now[i].text() for i in of],
                    [s.text() for s in then],
                    [now[i].resemblance(s) for i, s in zip(of, then)],
                    [now[i].resemblance(now[i + 1]) for i in of],
                    [now[i].count() for i in of],
                    [now[i].containment(s) for i, s in zip(of, then)],
                ]
                kinds = [pa.int64(), pa.string(), pa.string(), pa.string()] + [pa.float64()] * 4
                yield pa.RecordBatch.from_arrays(
                    [rows.column("_key").take(pa.array(of))] + [pa.array(v, k) for v, k in zip(values, kinds)],
                    [key, *RESULT.names],
                )

    return run


def compare_with_edits(documents: DataFrame, key: str = "doc_id", text: str = "text", size: int = SKETCH_SIZE) -> DataFrame:
    """Every document's sketch beside that of its edited text and its likeness to both neighbours.

    The edited text has the last quarter of the code points replaced by the start of the next
    document in order of (key, text), the first one after the last. NULL texts are empty, NULL keys
    come first, equal keys order by text, a single document is its own next one. Rows move once:
    ranges of keys are cut at keys that exist, and each range borrows the first row of the next, so
    no range waits for another. The cuts are quantiles, a few per shuffle partition.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = BUCKETS_PER_PARTITION * partitions
    cuts, nulls = rows.agg(
        F.percentile_approx("_key", [i / wanted for i in range(wanted)], max(10_000, 10 * wanted)), F.max(F.col("_key").isNull())
    ).first()
    schema = T.StructType([T.StructField(key, T.LongType()), *RESULT])
    if cuts is None and not nulls:
        return spark.createDataFrame([], schema)
    least = rows.agg(F.min("_key")).first()[0]
    cuts = np.unique(np.array([*(cuts or []), least if least is not None else 0], np.int64))
    dealt = rows.mapInArrow(_deal(cuts, bool(nulls)), "_bucket long, _lent boolean, _key long, _text string")
    ordered = dealt.repartition(partitions, "_bucket").sortWithinPartitions("_bucket", "_lent", "_key", "_text")
    return ordered.mapInArrow(_compare(key, size), schema)
