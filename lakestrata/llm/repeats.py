"""Repeated byte strings across documents, by enhanced suffix arrays over the places that may repeat.

Every string of ``least`` bytes has an anchor: the place in it whose seed (a short run of bytes) has
the least hash, the first of equals. Equal strings have equal anchors, so strings need only be
compared within one anchor's seed. The bytes around a seed in which it stays the anchor are its
context; all of a document's strings of ``least`` bytes lie in the contexts of its anchors, each in
one. Occurrences of one context repeat each other at once. Different contexts of a seed are sorted
as suffixes; the intervals of the common-prefix tree are their repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.names import apart
from lakestrata.llm.words import BYTE_VALUES, PLACES, _tables, mix, slices, text_bytes
from lakestrata.session import new_scratch

U64 = np.uint64
LEAST_BYTES = 100
SEED_BYTES = 40
PLACE_BITS = 24
ANCHOR_BYTES = 2 << 20
CHUNK_CONTEXTS = 4096

# of a place row: place << 16 | bytes from context start to anchor << 8 | string starts in the context
PLACES_SCHEMA = "seed long, context long, _key long, _version long, place long"
SPANS_SCHEMA = "_key long, _version long, start long, stop long"


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes the place of its least one, the first of equals.

    The place is packed below the hash; runs are minima of block suffixes and prefixes.
    """
    mask = U64((1 << PLACE_BITS) - 1)
    found = []
    step = (1 << PLACE_BITS) - width
    for at in range(0, len(hashes) - width + 1, step):
        part = hashes[at : at + step + width - 1]
        keys = (part & ~mask) | np.arange(len(part), dtype=U64)
        blocks = np.full((-(-len(part) // width) + 1) * width, np.iinfo(U64).max, U64)
        blocks[: len(part)] = keys
        blocks = blocks.reshape(-1, width)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        runs = len(part) - width + 1
        least = np.minimum(back[:runs], ahead[width - 1 : width - 1 + runs])
        found.append((least & mask).astype(np.int64) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _anchored(data: np.ndarray, offsets: np.ndarray, least: int, seed: int):
    none = np.zeros(0, np.int64)
    if len(data) < least:
        return none, none, none, none, none.view(U64), none.view(U64)
    size = len(data)
    up, down = _tables(size + 1)
    sums = np.zeros(size + 1, U64)
    np.cumsum(BYTE_VALUES[data] * up[:size], out=sums[1:])
    hashes = mix((sums[seed:] - sums[:-seed]) * down[: size - seed + 1])
    anchor = _least_places(hashes, least - seed + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    starts = np.flatnonzero(np.arange(size - least + 1) + least <= ends[: size - least + 1])
    if not len(starts):
        return none, none, none, none, none.view(U64), none.view(U64)
    anchor = anchor[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    low, high = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    place = anchor[first]
    row = np.searchsorted(offsets, low, "right") - 1
    whole = (sums[high + least] - sums[low]) * down[low]
    context = mix(whole + (high + least - low).astype(U64) * PLACES[0] + (place - low).astype(U64) * PLACES[1])
    return row, place - offsets[row], place - low, high - low + 1, hashes[place], context


def _merged(keys: list[np.ndarray], start: np.ndarray, stop: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Spans of equal keys that overlap or touch, as one; rows must come sorted by (keys, start)."""
    if not len(start):
        return keys, start, stop
    new = np.ones(len(start), bool)
    same = np.ones(len(start) - 1, bool)
    for k in keys:
        same &= k[1:] == k[:-1]
    group = np.zeros(len(start), np.int64)
    group[1:] = np.cumsum(~same)
    # a running maximum within each group: lift every group above the one before
    span = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + group * span)
    new[1:] = ~same | (start[1:] + group[1:] * span > reach[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return [k[first] for k in keys], start[first], reach[last] - group[last] * span


def _rows(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64, copy=False)) for c in columns], names)


def _find_anchors(least: int, seed: int):
    """Places of all anchors that no earlier one in the same batch repeats; spans of those repeated.

    A repeated place is a row without seed: bytes ``place`` to ``context`` of its text.
    """
    names = ["seed", "context", "_key", "_version", "place"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            parts = []
            for batch in slices(whole, "_text", ANCHOR_BYTES):
                row, *found = _anchored(*text_bytes(batch.column("_text")), least, seed)
                parts.append([*(np.asarray(batch.column(c))[row] for c in ("_key", "_version")), *found])
            if not parts:
                continue
            key, version, place, before, starts, h, c = (np.concatenate(p) for p in zip(*parts))
            order = np.lexsort((place, version, key, c, h))
            key, version, place, before, starts, h, c = (x[order] for x in (key, version, place, before, starts, h, c))
            same = np.zeros(len(h), bool)
            same[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
            again = same.copy()
            again[1:] &= (key[1:] == key[:-1]) & (version[1:] == version[:-1]) & (place[1:] == place[:-1])
            packed = place << 16 | before << 8 | starts - 1
            yield _rows(names, [h[~same].view(np.int64), c[~same].view(np.int64), key[~same], version[~same], packed[~same]])
            spans = same & ~again
            key, version, place, before, starts = (x[spans] for x in (key, version, place, before, starts))
            low = place - before
            order = np.lexsort((low, version, key))
            (key, version), low, high = _merged([key[order], version[order]], low[order], (low + starts - 1 + least)[order])
            yield _rows(names, [pa.nulls(len(low), pa.int64()), high, key, version, low])

    return run


def _compare_contexts(least: int):
    """Rows sorted by (seed, context, place): spans of all but the first occurrence of a context,
    and the first occurrences where a seed has several contexts. A span row has no seed."""
    names = ["seed", "_key", "_version", "start", "stop"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((0, 5), np.int64)
        pending = np.zeros((0, 5), np.int64)  # the first context of a seed with no second so far
        for batch in batches:
            known = np.asarray(batch.column("seed").is_valid())
            passed = batch.filter(pa.array(~known))
            if passed.num_rows:
                yield _rows(names, [passed.column(c) for c in ("seed", "_key", "_version", "place", "context")])
            batch = batch.filter(pa.array(known))
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(c) for c in batch.columns], axis=1)
            before = np.concatenate([last, rows])[-len(rows) - 1 : -1] if len(last) else np.concatenate([~rows[:1], rows[:-1]])
            last = rows[-1:]
            new_seed = rows[:, 0] != before[:, 0]
            new_context = new_seed | (rows[:, 1] != before[:, 1])
            again = ~new_context & (rows[:, 2:] != before[:, 2:]).any(axis=1)
            place = rows[again, 4]
            low = (place >> 16) - (place >> 8 & 255)
            yield _rows(names, [pa.nulls(len(low), pa.int64()), rows[again, 2], rows[again, 3], low, low + (place & 255) + least])
            first, fresh = rows[new_context], new_seed[new_context]
            if not len(first):
                continue
            several = ~fresh
            several[:-1] |= ~fresh[1:]
            asked = first[several] if fresh[0] else np.concatenate([pending, first[several]])
            pending = first[-1:] if fresh[-1] else pending[:0]
            yield _rows(names, [asked[:, 0], asked[:, 2], asked[:, 3], asked[:, 4], pa.nulls(len(asked), pa.int64())])

    return run


def _cut_contexts(least: int):
    """The bytes of every asked context."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_bytes"):
                out = []
                for key, version, text, asked in zip(*(batch.column(c).to_pylist() for c in ("_key", "_version", "_bytes", "asked"))):
                    for one in asked:
                        place = one["start"]
                        low = (place >> 16) - (place >> 8 & 255)
                        out.append((one["seed"], key, version, low, text[low : low + (place & 255) + least]))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["seed", "_key", "_version", "start", "bytes"]
                )

    return run


def common_prefix_intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(length, first, last)`` of every interval of the common-prefix tree, children first.

    ``prefixes[i]`` is the length of the common prefix of sorted suffixes i and i + 1.
    """
    stack: list[tuple[int, int]] = []
    for i, length in enumerate([*prefixes, 0]):
        first = i
        while stack and stack[-1][0] > length:
            tall, first = stack.pop()
            yield tall, first, i
        if length and not (stack and stack[-1][0] == length):
            stack.append((length, first))


def _common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; ``known`` bytes are known to agree."""
    size = min(len(a), len(b))
    while known < size and a[known] == b[known]:
        known += 1
    return known


class RepeatIndex:
    """An enhanced suffix array over texts in groups; only suffixes of one group are compared.

    It holds the suffixes of at least ``least`` bytes, sorted by their first ``least``; texts come
    in order of place, so of equal suffixes the first is the earliest.
    """

    def __init__(self, texts: list[bytes], groups: np.ndarray, least: int = LEAST_BYTES):
        self.texts, self.least = texts, least
        sizes = np.array([len(t) for t in texts], np.int64)
        base = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(sizes, out=base[1:])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        counts = np.maximum(sizes - least + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), counts)
        self.at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        place = base[self.text] + self.at
        keys = np.empty((len(place), 4 + least), np.uint8)
        if len(place):
            keys[:, :4] = groups[self.text].astype(">u4").view(np.uint8).reshape(-1, 4)
            keys[:, 4:] = np.lib.stride_tricks.sliding_window_view(self.data, least)[place]
        keys = keys.view(f"S{4 + least}").ravel()
        order = np.argsort(keys, kind="stable")
        self.text, self.at, place, keys = self.text[order], self.at[order], place[order], keys[order]
        self.new = np.ones(len(keys), bool)  # starts a run of suffixes with equal first bytes
        self.new[1:] = keys[1:] != keys[:-1]
        # the byte before a suffix; texts' own starts count as all different
        self.left = np.where(self.at > 0, self.data[np.maximum(place - 1, 0)].astype(np.int64), -1 - np.arange(len(place)))

    def repeats(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Every maximal repeat as (length, texts, places in them): all its occurrences, earliest first.

        A repeat whose occurrences all follow the same byte is part of a longer one and left out.
        """
        starts = np.flatnonzero(self.new)
        if not len(starts):
            return
        ends = np.append(starts[1:], len(self.new))
        diverse = np.minimum.reduceat(self.left, starts) != np.maximum.reduceat(self.left, starts)
        for a, b in zip(starts[diverse].tolist(), ends[diverse].tolist()):
            text, at, left = self.text[a:b], self.at[a:b], self.left[a:b]
            suffixes = [self.texts[t][o:] for t, o in zip(text.tolist(), at.tolist())]
            order = sorted(range(b - a), key=suffixes.__getitem__)
            prefixes = [_common(suffixes[x], suffixes[y], self.least) for x, y in zip(order, order[1:])]
            order = np.array(order)
            for length, first, last in common_prefix_intervals(prefixes):
                members = np.sort(order[first : last + 1])
                if left[members].min() != left[members].max():
                    yield length, text[members], at[members]

    def open_starts(self) -> tuple[np.ndarray, np.ndarray]:
        """(texts, places) of the suffixes without an earlier equal one here."""
        return self.text[self.new], self.at[self.new]


def _index_contexts(least: int, chunk: int):
    """Rows sorted by (seed, place): spans of all repeats but their earliest occurrences.

    A seed with more contexts than a chunk holds is indexed chunk by chunk, and what a chunk leaves
    open goes out as rows with a 128-bit hash of the string, to be settled across chunks.
    """
    names = ["_key", "_version", "start", "stop", "hash_a", "hash_b"]

    def settle(held: pa.Table, split: bool) -> Iterator[pa.RecordBatch]:
        rows = np.stack([np.asarray(held.column(c)) for c in ("seed", "_key", "_version", "start")], axis=1)
        repeated = np.append(False, (rows[1:] == rows[:-1]).all(axis=1))  # of rows given twice
        if repeated.any():
            held, rows = held.filter(pa.array(~repeated)), rows[~repeated]
        seeds, keys, versions, starts = rows.T
        groups = np.cumsum(np.append(0, seeds[1:] != seeds[:-1]))
        index = RepeatIndex(held.column("bytes").to_pylist(), groups, least)
        found = [(text[1:], at[1:], np.full(len(text) - 1, length)) for length, text, at in index.repeats()]
        if found:
            text, at, length = (np.concatenate(p) for p in zip(*found))
            key, version, low = keys[text], versions[text], starts[text] + at
            order = np.lexsort((low, version, key))
            (key, version), low, high = _merged([key[order], version[order]], low[order], (low + length)[order])
            nothing = pa.nulls(len(low), pa.int64())
            yield _rows(names, [key, version, low, high, nothing, nothing])
        if split:
            text, at = index.open_starts()
            hashes = b"".join(hashlib.blake2b(index.texts[t][o : o + least], digest_size=16).digest() for t, o in zip(text, at))
            pairs = np.frombuffer(hashes, np.int64).reshape(-1, 2)
            low = starts[text] + at
            yield _rows(names, [keys[text], versions[text], low, low + least, pairs[:, 0], pairs[:, 1]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        splitting = None  # the seed of which a chunk went last
        for batch in batches:
            held = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            while held.num_rows > chunk:
                seeds = np.asarray(held.column("seed"))
                cuts = np.flatnonzero(seeds[1:] != seeds[:-1]) + 1
                own = int(cuts[0]) if len(cuts) else held.num_rows
                if seeds[0] == splitting or own > chunk:
                    to, splitting = min(own, chunk), int(seeds[0])
                else:
                    to, splitting = int(cuts[cuts <= chunk][-1]), None
                yield from settle(held.slice(0, to), splitting is not None)
                held = held.slice(to)
        if held is not None and held.num_rows:
            seeds = np.asarray(held.column("seed"))
            own = int((seeds == splitting).sum()) if splitting is not None else 0
            if own:
                yield from settle(held.slice(0, own), True)
            if own < held.num_rows:
                yield from settle(held.slice(own), False)

    return run


def _spans(documents: DataFrame, key: str, text: str, least: int, seed: int, chunk: int) -> DataFrame:
    """``(_key, _version, _spans)``: what to remove from each text that has something to remove."""
    spark = documents.sparkSession
    rows = _named(documents, key, text)
    places = rows.select("_key", "_version", "_text").mapInArrow(_find_anchors(least, seed), PLACES_SCHEMA)
    spread = F.coalesce("seed", F.xxhash64("_key", "_version", "place"))
    path = new_scratch(spark, "contexts")
    places.repartition(spread).sortWithinPartitions("seed", "context", "_key", "_version", "place").mapInArrow(
        _compare_contexts(least), f"seed long, {SPANS_SCHEMA}"
    ).write.parquet(path)
    compared = spark.read.schema(f"seed long, {SPANS_SCHEMA}").parquet(path)
    asked = compared.filter("seed is not null").groupBy("_key", "_version").agg(F.collect_list(F.struct("seed", "start")).alias("asked"))
    cut = rows.select("_key", "_version", F.col("_text").cast("binary").alias("_bytes"))
    contexts = cut.join(asked, ["_key", "_version"]).mapInArrow(
        _cut_contexts(least), "seed long, _key long, _version long, start long, bytes binary"
    )
    path = new_scratch(spark, "repeats")
    schema = f"{SPANS_SCHEMA}, hash_a long, hash_b long"
    contexts.repartition("seed").sortWithinPartitions("seed", "_key", "_version", "start").mapInArrow(
        _index_contexts(least, chunk), schema
    ).write.parquet(path)
    indexed = spark.read.schema(schema).parquet(path)
    left = indexed.filter("hash_a is not null")
    first = left.groupBy("hash_a", "hash_b").agg(F.min(F.struct("_key", "_version", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    across = left.join(first, ["hash_a", "hash_b"]).filter(F.struct("_key", "_version", "start") > F.col("first"))
    names = ["_key", "_version", "start", "stop"]
    spans = compared.filter("seed is null").select(names).unionByName(indexed.filter("hash_a is null").select(names)).unionByName(across.select(names))
    return spans.groupBy("_key", "_version").agg(F.collect_list(F.struct("start", "stop")).alias("_spans"))


def _named(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Texts with the pair that names them: rows that share a key differ by the text's hash.

    NULL keys get the least long, so they come before all others.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    return documents.select(
        "*",
        F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_key"),
        F.xxhash64(value).alias("_version"),
        value.alias("_text"),
    )


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """The bytes outside all spans, the number removed, and of how many separate runs."""
    parts, at, removed, runs = [], 0, 0, 0
    reach = -1
    for span in sorted((s["start"], s["stop"]) for s in spans or ()):
        if span[0] > reach:
            runs += 1
            parts.append(text[at : span[0]])
            removed += span[1] - span[0]
            at = reach = span[1]
        elif span[1] > reach:
            removed += span[1] - reach
            at = reach = span[1]
    parts.append(text[at:])
    return b"".join(parts), removed, runs


def _apply(documents: DataFrame, key: str, text: str, least: int, seed: int, chunk: int) -> DataFrame:
    spans = _spans(documents, key, text, least, seed, chunk)
    return _named(documents, key, text).join(spans, ["_key", "_version"], "left")


def repeat_digests(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_BYTES,
    seed: int = SEED_BYTES,
    chunk: int = CHUNK_CONTEXTS,
) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept_sha256)`` for every row; see ``remove_repeats``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_bytes"):
                out = []
                for value, spans in zip(batch.column("_bytes").to_pylist(), batch.column("_spans").to_pylist()):
                    kept, removed, runs = _kept(value, spans)
                    out.append((len(value), removed, runs, hashlib.sha256(kept).hexdigest()))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                    [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    kind = documents.schema[key].dataType.simpleString()
    joined = _apply(documents.select(key, text), key, text, least, seed, chunk)
    return joined.select(key, F.col("_text").cast("binary").alias("_bytes"), "_spans").mapInArrow(
        run, f"{key} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeats(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = LEAST_BYTES,
    seed: int = SEED_BYTES,
    chunk: int = CHUNK_CONTEXTS,
) -> DataFrame:
    """``documents`` with every byte cut that lies in a repeat of at least ``least`` UTF-8 bytes,
    save the repeat's earliest occurrence (least key, then first place); same columns and rows.

    Strings are judged on the whole input, never across documents. What is left of a character cut
    in part goes too; a text without a repeat is returned as it came, NULL as NULL. NULL keys come
    before all others. Rows that share a key but not the text are different documents, in order of
    a hash of the text; equal rows are one document and lose the same bytes.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_).to_pylist()
            for row, spans in enumerate(batch.column("_spans").to_pylist()):
                if spans:
                    texts[row] = _kept(texts[row].encode(), spans)[0].decode(errors="ignore")
            at = batch.schema.get_field_index(text_)
            changed = batch.set_column(at, text_, pa.array(texts, batch.schema.field(at).type))
            yield changed.select(names)

    docs, (key_, text_) = apart(documents, key, text)
    names = docs.columns
    joined = _apply(docs, key_, text_, least, seed, chunk)
    return joined.select(*names, "_spans").mapInArrow(run, docs.schema).toDF(*documents.columns)
