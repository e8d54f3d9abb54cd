"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

Each permutation gives two signature values, its minimum and its maximum. Banding finds candidate
groups; every group is compared with its least member (a star), and members that don't link with
it are compared with the rest through their differences from it, in blocks. Only confirmed links
count, and only a spanning part of them is ever written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.components import components
from lakestrata.llm.names import apart
from lakestrata.llm.words import mix, numbers, shingle_hashes, slices, text_bytes, word_hashes
from lakestrata.session import new_scratch

U64 = np.uint64
PERMUTATIONS = 112
BANDS = 32
CHUNK_MEMBERS = 256
BLOCK_BYTES = 2 << 20

SIGNATURES = "_key long, version long, n_shingles long, digest_a long, digest_b long, bands array<long>"
STARS = "leader long, member long, size long, linked boolean, difference binary"
LINKS = "first long, second long"


def _permuted(sets: np.ndarray, rows: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum of every row under each permutation: rows x (2 * permutations)."""
    factors = numbers(11, permutations) | U64(1)
    shifts = numbers(12, permutations)
    out = np.empty((len(rows) - 1, 2 * permutations), U64)
    for j in range(permutations):
        values = sets * factors[j]
        values ^= values >> U64(32)
        values *= shifts[j] | U64(1)
        out[:, 2 * j] = np.minimum.reduceat(values, rows[:-1])
        out[:, 2 * j + 1] = np.maximum.reduceat(values, rows[:-1])
    return out


def _banded(signature: np.ndarray, bands: int) -> np.ndarray:
    """One key per row and band; a band's values come from different permutations."""
    rows, width = signature.shape
    per_band = width // bands
    lows, highs = signature[:, 0::2], signature[:, 1::2]
    spread = np.concatenate([lows, highs], axis=1)[:, : per_band * bands].reshape(rows, bands, per_band)
    places = numbers(13, per_band) | U64(1)
    return mix((spread * places).sum(axis=2, dtype=U64) + np.arange(bands, dtype=U64))


def _signatures(permutations: int, bands: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                values, rows = shingle_hashes(*word_hashes(*text_bytes(batch.column("_text")), fold=True))
                sets = [np.unique(values[a:b]) for a, b in zip(rows[:-1], rows[1:])]
                sizes = np.array([len(s) for s in sets], np.int64)
                held = np.flatnonzero(sizes)
                keys = np.zeros((len(sets), bands), U64)
                digests = np.zeros((2, len(sets)), U64)
                if len(held):
                    joined = np.concatenate([sets[i] for i in held])
                    starts = np.zeros(len(held) + 1, np.int64)
                    np.cumsum(sizes[held], out=starts[1:])
                    keys[held] = _banded(_permuted(joined, starts, permutations), bands)
                    digests[0, held] = np.add.reduceat(mix(joined), starts[:-1])
                    digests[1, held] = np.bitwise_xor.reduceat(mix(joined + U64(1)), starts[:-1])
                flat = pa.array(keys.view(np.int64).ravel())
                offsets = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key"),
                        batch.column("version"),
                        pa.array(sizes),
                        *(pa.array(d.view(np.int64)) for d in digests),
                        pa.ListArray.from_arrays(offsets, flat),
                    ],
                    ["_key", "version", "n_shingles", "digest_a", "digest_b", "bands"],
                )

    return run


def _set_of(text: str | None) -> np.ndarray:
    values, _ = shingle_hashes(*word_hashes(*text_bytes(pa.array([text], pa.string())), fold=True))
    return np.unique(values)


def _is_link(shared, a, b, percent: int):
    """``100 * shared >= percent * union`` in whole numbers."""
    return 100 * shared >= percent * (a + b - shared)


def _stars(percent: int):
    """Rows sorted by (leader, chunk, leader first): each member against its leader."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(0, U64)
        for whole in batches:
            for batch in slices(whole, "_text"):
                out = []
                for of, key, digest, text in zip(*(batch.column(c).to_pylist() for c in ("leader", "member", "digest_a", "_text"))):
                    found = _set_of(text)
                    if mix(found).sum(dtype=U64).astype(np.int64) != digest:
                        continue  # another row that shares the key
                    if key == of:
                        own = found
                        continue
                    differing = np.setxor1d(own, found, assume_unique=True)
                    shared = (len(own) + len(found) - len(differing)) // 2
                    out.append((of, key, len(found), bool(_is_link(shared, len(own), len(found), percent)), differing.tobytes()))
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["leader", "member", "size", "linked", "difference"]
                    )

    return run


def _block_links(percent: int):
    """Spanning links between the members of a block (or of two), by differences from the leader.

    Two members differ exactly where their differences do. Members that link with the leader are
    one group already, so they are only held against those that don't.
    """

    def run(frame):
        frame = frame.sort_values(["linked", "member"], kind="stable")
        sets = [np.frombuffer(d, U64) for d in frame["difference"]]
        members, sizes, block = (frame[c].to_numpy() for c in ("member", "size", "block"))
        lengths = np.array([len(s) for s in sets])
        apart = int((~frame["linked"]).sum())
        group = np.minimum(np.arange(len(sets)), apart)
        values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared_by_some = counts[place] > 1
        owner, place = np.repeat(np.arange(len(sets)), lengths)[shared_by_some], place[shared_by_some]
        one_block = (block == block[0]).all()
        links = []
        for i in range(apart):
            own = np.zeros(len(values), bool)
            own[place[owner == i]] = True
            both = np.bincount(owner[own[place]], minlength=len(sets))
            shared = (sizes[i] + sizes - (lengths[i] + lengths - 2 * both)) // 2
            near = _is_link(shared, sizes[i], sizes, percent)
            near[: i + 1] = False
            if not one_block:
                near &= block != block[i]
            for j in np.flatnonzero(near):
                if group[j] != group[i]:
                    links.append((members[i], members[j]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(links, columns=["first", "second"], dtype="int64")

    return run


def _confirmed(requests: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The links of all stars and blocks: ``(first, second)``."""
    spark = requests.sparkSession
    path = new_scratch(spark, "stars")
    held = requests.join(texts, requests["member"] == texts["_key"]).drop("_key")
    ordered = held.repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", F.col("member") != F.col("leader"), "member")
    ordered.mapInArrow(_stars(percent), STARS).write.parquet(path)
    stars = spark.read.schema(STARS).parquet(path)
    mixed = stars.groupBy("leader").agg(
        F.count(F.lit(1)).alias("members"),
        F.max(~F.col("linked")).alias("mixed"),
        F.ceil(F.sum(F.octet_length("difference") + 64) / BLOCK_BYTES).cast("int").alias("blocks"),
    )
    dealt = (
        stars.join(mixed.filter("members > 1 and mixed"), "leader")
        .withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("leader", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "member", "size", "linked", "difference")
    )
    across = dealt.groupBy("leader", "x", "y").applyInPandas(_block_links(percent), LINKS)
    return stars.filter("linked").select(F.col("leader").alias("first"), F.col("member").alias("second")).unionByName(across)


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 85,
    permutations: int = PERMUTATIONS,
    bands: int = BANDS,
) -> DataFrame:
    """``(key, n_shingles, component_id, kept)`` for every row of ``documents``, an empty table has none.

    Two documents link when their sets of five-word shingles (A-Z lower-cased; fewer words are one
    shingle) have at least ``percent`` hundredths of their union in common. ``component_id`` is the
    least key reachable over links. With 112 permutations as 32 bands of 7 values a pair just at
    0.85 is missed with probability 4e-6, nearer ones far less. Sets are compared whole, as 64-bit
    shingle hashes.

    Equal sets are one class and only its least key is compared. Texts without words link with
    nothing. Rows that share a key are one document, known by the text with the least digest; all of
    them get its component. NULL keys have the component NULL and are kept.
    """
    return _judged(documents, key, text, percent, permutations, bands).select(key, "n_shingles", "component_id", "kept")


def _judged(documents: DataFrame, key: str, text: str, percent: int, permutations: int, bands: int) -> DataFrame:
    """``near_duplicates`` with ``version``, a hash of the text, and ``compared``: whether the row's text
    is the one that its key is known by."""
    spark = documents.sparkSession
    path = new_scratch(spark, "signatures")
    texts = documents.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    texts.withColumn("version", F.xxhash64("_text")).mapInArrow(_signatures(permutations, bands), SIGNATURES).write.parquet(path)
    signed = spark.read.schema(SIGNATURES).parquet(path)
    digest = ["digest_a", "digest_b"]
    held = signed.filter("n_shingles > 0 and _key is not null")
    nodes = held.groupBy("_key").agg(F.min(F.struct(*digest)).alias("_d")).select("_key", "_d.*")
    classes = nodes.groupBy(*digest).agg(F.min("_key").alias("rep"))
    banded = held.select("_key", *digest, F.explode("bands").alias("band")).join(
        classes.withColumnRenamed("rep", "_key"), ["_key", *digest], "left_semi"
    )
    least = banded.groupBy("band").agg(F.min("_key").alias("leader"), F.max("_key").alias("_last")).filter("leader < _last")
    path = new_scratch(spark, "candidates")
    pairs = banded.select("band", F.col("_key").alias("member")).join(least.select("band", "leader"), "band").filter("member <> leader")
    pairs.select("leader", "member").distinct().write.parquet(path)
    pairs = spark.read.schema("leader long, member long").parquet(path)
    chunks = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / CHUNK_MEMBERS).cast("int").alias("chunks"))
    asked = pairs.join(chunks, "leader").select("leader", F.pmod(F.xxhash64("member"), F.col("chunks")).cast("int").alias("chunk"), "member")
    heads = chunks.select("leader", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("leader").alias("member"))
    requests = asked.unionByName(heads).join(nodes.select(F.col("_key").alias("member"), "digest_a"), "member")
    links = _confirmed(requests, texts, percent)
    joined = components(links, "first", "second").select(F.col("node").alias("rep"), "component")
    named = nodes.join(classes, digest).join(joined, "rep", "left").select(
        "_key", F.coalesce("component", "rep").alias("component"), F.struct(*digest).alias("known_by")
    )
    found = signed.select("_key", "version", "n_shingles", F.struct(*digest).alias("own")).join(named, "_key", "left")
    component = F.coalesce("component", "_key")
    return found.select(
        F.col("_key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept"),
        "version",
        F.coalesce(F.col("own") == F.col("known_by"), F.lit(False)).alias("compared"),
    )


def drop_near_duplicates(
    documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 80, permutations: int = 128, bands: int = 42
) -> DataFrame:
    """``documents`` without the rows whose key is not its group's least; same columns, whatever their names.

    A row only goes if its own text was compared: other texts under the key of a near copy stay, and
    so do rows with a NULL key, texts without words, and all rows that are equal to a kept one. At
    0.8, 128 permutations as 42 bands of 6 values miss a pair with probability 3e-6.
    """
    docs, (key_, text_) = apart(documents, key, text)
    judged = _judged(docs, key_, text_, percent, permutations, bands)
    gone = judged.filter("not kept and compared").select(F.col(key_).alias("_gone"), F.col("version").alias("_gone_version")).distinct()
    same = (F.col(key_).cast("long") == F.col("_gone")) & (F.xxhash64(text_) == F.col("_gone_version"))
    return docs.join(gone, same, "left_anti").toDF(*documents.columns)
