"""Sampled segmentations of a unigram model: forward filtering, backward sampling over the piece lattice."""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.unigram import PRETOKEN, Vocabulary, finder, vocabulary
from lakestrata.llm.words import mix, numbers, slices, text_bytes

U64 = np.uint64
SHARPNESS = 0.5
LATTICE_NODES = 2_500_000
SLICE_BYTES = 1 << 20
SHARE_BITS = 52
STEPS = numbers(31, 64)
TINY, LIFT = 1e-150, 1e150


class Lattices:
    """The filtered lattices of all pre-tokens met, in flat arrays.

    A node is a place in a pre-token, ``end`` maps a pre-token to its last one. Its edges are the
    pieces that end there, one after the other from ``first``; ``bounds`` has their chances summed
    up, in parts of 2**SHARE_BITS. Past ``limit`` nodes it starts anew between slices, which changes no draw: chances depend on
    the pre-token alone.
    """

    def __init__(self, vocab: Vocabulary, sharpness: float = SHARPNESS, limit: int = LATTICE_NODES):
        self.vocab, self.limit = vocab, limit
        self.finder = finder(vocab)
        self.weight = np.array([math.exp(sharpness * p) for p in self.finder.logp])
        self.byte_weight = math.exp(sharpness * vocab.fallback)
        self._empty()

    def _empty(self) -> None:
        self.end: dict[str, int] = {}
        self.first = array("q")
        self.bounds, self.sources, self.ids = array("Q"), array("i"), array("i")

    def add(self, tokens: Iterable[str]) -> None:
        """Filter the lattices of all pre-tokens that are new."""
        if len(self.first) > self.limit:
            self._empty()
        new = list(set(tokens).difference(self.end))
        if not new:
            return
        text = "".join(new)
        size = np.array([len(t) for t in new], np.int64)
        stop = np.cumsum(size)
        start, end, ids, entries = self.finder.edges(text, np.repeat(stop, size))
        weight = np.where(entries >= 0, self.weight[entries], self.byte_weight ** np.where(entries >= 0, 1, -entries))
        begin = np.repeat(stop - size, size)
        start, end, ids, shares = self._filtered(start, end, ids, weight, begin)
        base = len(self.first)
        counts = np.bincount(end, minlength=len(text))
        firsts = np.cumsum(counts) - counts
        # shares as whole numbers: their sums wrap around without rounding, so a node's bounds don't
        # depend on the nodes before it
        running = np.cumsum((shares * 2.0**SHARE_BITS).astype(U64))
        bounds = running - np.repeat(np.append(U64(0), running)[firsts], counts)
        bounds[firsts + counts - 1] = U64(1 << 63)
        self.first.frombytes((firsts + len(self.bounds)).astype(np.int64).tobytes())
        self.bounds.frombytes(bounds.tobytes())
        self.sources.frombytes(np.where(start > begin[end], base + start - 1, -1).astype(np.int32).tobytes())
        self.ids.frombytes(ids.astype(np.int32).tobytes())
        self.end.update(zip(new, (base + stop - 1).tolist()))

    def _filtered(self, start, end, ids, weight, begin) -> tuple[np.ndarray, ...]:
        """Edges in order of their end with their share of its forward sum.

        All pre-tokens advance together, one character at a time. Sums that become tiny are lifted
        with all that still count beside them.
        """
        depth = end - begin[end]
        order = np.lexsort((start, end, depth))
        start, end, ids, weight, depth = (x[order] for x in (start, end, ids, weight, depth))
        forward = np.zeros(len(begin))
        shares = np.zeros(len(start))
        cuts = np.flatnonzero(np.diff(depth)) + 1
        for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(start)).tolist()):
            s, e = start[a:b], end[a:b]
            inner = s > begin[e]
            part = np.where(inner, forward[s - 1], 1.0) * weight[a:b]
            heads = np.flatnonzero(np.append(True, e[1:] != e[:-1]))
            total = np.add.reduceat(part, heads)
            at = e[heads]
            shares[a:b] = part / np.repeat(total, np.diff(np.append(heads, len(e))))
            forward[at] = total
            tiny = at[total < TINY]
            if len(tiny):
                back = (tiny[:, None] - np.arange(self.vocab.longest + 1)).ravel()
                low = np.repeat(begin[tiny], self.vocab.longest + 1)
                forward[back[back >= low]] *= LIFT
        order = np.lexsort((start, end))
        return start[order], end[order], ids[order], shares[order]

    def arrays(self) -> tuple[np.ndarray, ...]:
        """First edges of the nodes; bounds, source nodes (-1 at the start) and piece ids of the
        edges, -1 - c for the bytes of a character c. Views: they must go before another lattice
        comes in."""
        views = ((self.first, np.int64), (self.bounds, U64), (self.sources, np.int32), (self.ids, np.int32))
        return tuple(np.frombuffer(v, kind) if len(v) else np.zeros(0, kind) for v, kind in views)


def _drawn_edges(first: np.ndarray, bounds: np.ndarray, u: np.ndarray) -> np.ndarray:
    """From every node's edges, beginning at ``first``, the one whose bound passes ``u``."""
    edge = first.copy()
    left = np.flatnonzero(u >= bounds[edge])
    while len(left):
        edge[left] += 1
        left = left[u[left] >= bounds[edge[left]]]
    return edge


def _uniform(seeds: np.ndarray, step: int) -> np.ndarray:
    """Whole numbers below 2**SHARE_BITS that depend on seed and step alone."""
    return mix(seeds + STEPS[step % len(STEPS)] + U64(step)) >> U64(64 - SHARE_BITS)


def sample(lattices: Lattices, texts: list[str], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a drawn segmentation of every text, one after the other, and the texts' offsets."""
    found = [PRETOKEN.findall(t) for t in texts]
    counts = np.array([len(f) for f in found], np.int64)
    total = int(counts.sum())
    lattices.add(chain.from_iterable(found))
    node = np.fromiter(map(lattices.end.__getitem__, chain.from_iterable(found)), np.int64, total)
    first, bounds, sources, pieces = lattices.arrays()
    place = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    seed = mix(np.repeat(seeds, counts) ^ mix(place.astype(U64) + U64(1)))
    steps = np.zeros(total, np.int64)
    drawn, active = [], np.arange(total)
    while len(active):
        edge = _drawn_edges(first[node[active]], bounds, _uniform(seed[active], len(drawn)))
        drawn.append((active, edge))
        steps[active] += 1
        node[active] = sources[edge]
        active = active[sources[edge] >= 0]
    # steps run backwards: the first one drawn is a pre-token's last piece
    ends = np.cumsum(steps)
    ids = np.zeros(int(ends[-1]) if total else 0, np.int32)
    for back, (of, edge) in enumerate(drawn, 1):
        ids[ends[of] - back] = pieces[edge]
    offsets = np.append(0, ends)[np.append(0, np.cumsum(counts))]
    unknown = np.flatnonzero(ids < 0)
    if len(unknown):
        spelled = [[lattices.vocab.byte_ids[b] for b in chr(-1 - i).encode()] for i in ids[unknown].tolist()]
        width = np.ones(len(ids), np.int64)
        width[unknown] = [len(x) for x in spelled]
        before = np.append(0, np.cumsum(width))
        known = np.repeat(ids, width)
        known[np.repeat(ids < 0, width)] = list(chain.from_iterable(spelled))
        ids, offsets = known, before[offsets]
    return ids, offsets


def _decode_to(vocab: Vocabulary, ids: np.ndarray, offsets: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each row's ids decode to the row's bytes of ``data``."""
    content, starts, sizes = vocab.contents
    size = sizes[ids]
    ends = np.append(0, np.cumsum(size))
    decoded = content[np.repeat(starts[ids] - ends[:-1], size) + np.arange(ends[-1])]
    rows = ends[offsets]
    if len(decoded) == len(data) and (rows == bounds).all() and (decoded == data).all():
        return np.ones(len(bounds) - 1, bool)
    return np.array([np.array_equal(decoded[a:b], data[c:d]) for a, b, c, d in zip(rows, rows[1:], bounds, bounds[1:])], bool)


def sampled_encoding(
    documents: DataFrame, model: str, key: str = "doc_id", text: str = "text", sharpness: float = SHARPNESS, seed: int = 0
) -> DataFrame:
    """``(key, n_pieces, ids, lossless)`` of every row: a segmentation of the whole text drawn from
    the unigram model's posterior, with chances raised to ``sharpness``.

    A draw depends on the row's key, the text and ``seed`` alone, not on partitions or retries.
    ``lossless`` says whether the ids decode to the text; they always must. NULL and empty texts
    have no ids; NULL keys draw like the key "". Repeated rows are drawn alike.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        if (model, sharpness) not in _lattices:
            _lattices[model, sharpness] = Lattices(vocab, sharpness)
        lattices = _lattices[model, sharpness]
        for whole in batches:
            for batch in slices(whole, "_text", SLICE_BYTES):
                texts = [t or "" for t in batch.column("_text").to_pylist()]
                data, bounds = text_bytes(batch.column("_text"))
                seeds = np.asarray(batch.column("_seed")).astype(np.int64).view(U64)
                ids, offsets = sample(lattices, texts, seeds)
                lossless = _decode_to(vocab, ids, offsets, data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_key"),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                        pa.array(lossless),
                    ],
                    [key, "n_pieces", "ids", "lossless"],
                )

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(
        F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)).alias("_seed")
    )
    return rows.mapInArrow(run, f"{key} {kind}, n_pieces long, ids array<int>, lossless boolean")


def decode_pieces(encoded: DataFrame, model: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)`` from rows of ids; NULL ids are an empty text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = vocabulary(model).decode
        for batch in batches:
            texts = [decode(row or ()) for row in batch.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(texts, pa.string())], [key, "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("_key"), F.col(ids).alias("_ids")).mapInArrow(run, f"{key} {kind}, text string")


_lattices: dict[tuple[str, float], Lattices] = {}
