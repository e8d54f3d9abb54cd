"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.words import slices
from lakestrata.session import new_scratch

CAPACITY = 2048
END_ID = 0
CACHE_WORDS = 300_000
GROUP_PIECES = 20_000
#: fixed values: the vocabulary's split pattern and its one special token
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|endoftext|>"
LONG_BLANK = 10_000
BLANK = re.compile(rf"\s{{{LONG_BLANK}}}")


class _Unsafe(Exception):
    """A part that can't be encoded apart from its neighbours."""


class Encoder(dict):
    """Ids of a byte-level BPE vocabulary as little-endian unsigned 32-bit bytes.

    Parts between single spaces encode apart from each other when no white space touches the space,
    because the split pattern then always cuts before it; their ids are remembered. Any other text
    is encoded whole, and one with the special token or a long run of white space by the
    vocabulary's own tokenizer.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._plain = tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=known, special_tokens={}).encode_ordinary
        self.full = Tokenizer.from_file(vocabulary)

    def plain(self, text: str) -> list[int]:
        """The ids of a text without the special token. A run of white space deepens the faster
        encoder's stack by each of its characters, so long ones are for the vocabulary's own."""
        if len(text) > LONG_BLANK and BLANK.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return self._plain(text)

    def __missing__(self, part: str) -> bytes:
        if not part or part[0].isspace() or part[-1].isspace() or SPECIAL in part:
            raise _Unsafe
        if len(self) >= CACHE_WORDS:
            self.clear()
        ids = np.array(self.plain(" " + part), "<u4").tobytes()
        self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if SPECIAL in text:
            return np.array(self.full.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, space, rest = text.partition(" ")
        if first and space and not first[-1].isspace():
            try:
                after = b"".join(map(self.__getitem__, rest.split(" ")))
                return np.array(self.plain(first), "<u4").tobytes() + after
            except _Unsafe:
                pass
        return np.array(self.plain(text), "<u4").tobytes()


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(vocabulary: str, ranks: str) -> Encoder:
    """One per Python worker."""
    if (vocabulary, ranks) not in _encoders:
        _encoders[vocabulary, ranks] = Encoder(vocabulary, ranks)
    return _encoders[vocabulary, ranks]


def cut_pieces(
    documents: DataFrame,
    vocabulary: str,
    ranks: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``(key, piece, start, length, ids_crc32, ids)`` of every document's ids and the end id.

    Longer ones than ``capacity`` are cut into full pieces after a first one that takes the rest.
    NULL and empty texts are the end id alone; NULL keys and repeated rows are documents like any; an
    empty table has no pieces.
    ``ids`` are the piece's ids as little-endian unsigned 32-bit bytes, NULL unless asked for.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, ranks).encode
        end = END_ID.to_bytes(4, "little")
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows = []
                for row, value in enumerate(batch.column("_text").to_pylist()):
                    ids = encode(value or "") + end
                    size = len(ids) // 4
                    starts = [0, *range((size - 1) % capacity + 1, size, capacity)]
                    for piece, (at, to) in enumerate(zip(starts, [*starts[1:], size])):
                        part = ids[4 * at : 4 * to]
                        rows.append((row, piece, at, to - at, zlib.crc32(part), part if with_ids else None))
                of, *columns = zip(*rows)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").take(pa.array(of)), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                    [key, "piece", "start", "length", "ids_crc32", "ids"],
                )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        run, f"{key} {kind}, piece int, start long, length long, ids_crc32 long, ids binary"
    )


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of every piece, placed in the order given.

    With N(g) open bins of gap g, a piece of length s goes where the sum of N(g)**2 becomes least:
    filling gap g to g - s changes it by 2 (N(g - s) - N(g) + 1), closing a gap by 1 - 2 N(g), a
    new bin by 2 N(capacity - s) + 1. Of equal changes the smallest gap wins, a new bin comes last.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = 0
    far = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        gaps = count[s:]
        change = np.where(gaps > 0, 2 * (count[: capacity + 1 - s] - gaps + 1), far)
        if gaps[0]:
            change[0] = 1 - 2 * gaps[0]
        best = int(change.argmin())
        fresh = 1 if s == capacity else 2 * count[capacity - s] + 1
        if change[best] > fresh or not gaps[best]:
            gap, to = capacity, used
            used += 1
        else:
            gap = s + best
            to = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = to, capacity - gap
        if gap > s:
            open_bins[gap - s].append(to)
            count[gap - s] += 1
    return bins, offsets


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (no longer than ``capacity`` each) with ``sequence_id`` and ``offset``.

    Pieces are dealt evenly into groups of about ``group_pieces``, whatever their keys; each group
    is packed by itself, longest piece first, so it costs at most a few open sequences. ``pieces``
    must be a stored table: its rows are counted, then dealt by their place in it.
    """
    groups = -(-max(pieces.count(), 1) // group_pieces)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def pack(frame):
        frame = frame.sort_values("length", ascending=False, kind="stable")
        bins, offsets = sum_of_squares(frame["length"].to_numpy(), capacity)
        group = int(frame["_group"].iloc[0])
        return frame.drop(columns="_group").assign(sequence_id=(group << 32) + bins, offset=offsets)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("_group").applyInPandas(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    ranks: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """All documents as pieces in sequences of at most ``capacity`` ids.

    One row per piece: ``(key, piece, start, length, ids_crc32, ids, sequence_id, offset)``. NULL
    and empty texts are the end id alone; NULL keys and repeated rows are documents of their own.
    The pieces are written once to the shared scratch folder, so texts never move.
    """
    spark = documents.sparkSession
    path = new_scratch(spark, "pieces")
    pieces = cut_pieces(documents, vocabulary, ranks, key, text, capacity, with_ids)
    pieces.write.parquet(path)
    return pack_pieces(spark.read.schema(pieces.schema).parquet(path), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_ids, ids)``: the content of every sequence, from pieces with their ids."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    made = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_ids"), rows.alias("_rows"))
    joined = F.aggregate("_rows", F.lit(b""), lambda all_ids, row: F.concat(all_ids, row["ids"]))
    return made.select("sequence_id", "n_ids", joined.alias("ids"))
