"""Vectorised words and shingles over the UTF-8 bytes of Arrow text columns.

A word is a run of bytes other than space and \\x09-\\x0D. Words and shingles are known by 64-bit
hashes: of random odd multipliers per place, over a random value per byte, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SHINGLE_WORDS = 5
WINDOW_BYTES = 1 << 20
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, count + 1, dtype=U64) + (U64(seed) << U64(32))) * U64(0x9E3779B97F4A7C15))


BYTE_VALUES = numbers(1, 256)
FOLDED_VALUES = BYTE_VALUES[LOWER]
BASE = numbers(2, 1)[0] | U64(1)
PLACES = numbers(3, 64) | U64(1)


def _inverse(odd: np.uint64) -> np.uint64:
    """Of an odd number modulo 2**64."""
    return U64(pow(int(odd), -1, 1 << 64))


_powers: dict[str, np.ndarray] = {}


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < size:
        for name, base in (("up", BASE), ("down", _inverse(BASE))):
            values = np.full(size, base, U64)
            values[0] = 1
            _powers[name] = np.multiply.accumulate(values)
    return _powers["up"], _powers["down"]


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows, one after the other, and their n + 1 offsets; NULL rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``limit`` bytes of text each."""
    _, offsets = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def _windows(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of about ``WINDOW_BYTES`` that no word crosses."""
    at, size = 0, len(data)
    while at < size:
        to = min(at + WINDOW_BYTES, size)
        if to < size:
            row = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if row > at:
                to = row
            else:
                gaps = np.flatnonzero(SPACE[data[at:to]])
                if len(gaps):
                    to = at + int(gaps[-1]) + 1
                else:
                    end = int(offsets[np.searchsorted(offsets, to, "right")])
                    gaps = np.flatnonzero(SPACE[data[to:end]])
                    to = to + int(gaps[0]) if len(gaps) else end
        yield at, to
        at = to


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of ``data``, whose rows start at ``offsets``."""
    gap = SPACE[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    before[edges] = True
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    after[edges - 1] = True
    return np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word in order, and the n + 1 offsets of the rows into them.

    With ``fold`` A-Z count as a-z.
    """
    values = FOLDED_VALUES if fold else BYTE_VALUES
    found, firsts = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for at, to in _windows(data, offsets):
        inside = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to, "right")] - at
        starts, ends = word_spans(data[at:to], inside)
        up, down = _tables(max(to - at, WINDOW_BYTES))
        sums = np.zeros(to - at + 1, U64)
        np.cumsum(values[data[at:to]] * up[: to - at], out=sums[1:])
        found.append(mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64)))
        firsts.append(starts + at)
    return np.concatenate(found), np.searchsorted(np.concatenate(firsts), offsets)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every run of ``width`` words, and the rows' offsets into them.

    A row of fewer words has one shingle, its whole sequence; a row without words has none.
    """
    n = np.diff(offsets)
    full = n >= width
    rows = np.zeros(len(n) + 1, np.int64)
    np.cumsum(np.where(full, n - width + 1, (n > 0).astype(np.int64)), out=rows[1:])
    values = np.zeros(rows[-1], U64)
    short = np.flatnonzero(~full & (n > 0))
    for size in range(1, width):
        of = short[n[short] == size]
        total = np.full(len(of), size, U64)
        for j in range(size):
            total += words[offsets[of] + j] * PLACES[j]
        values[rows[of]] = mix(total)
    if len(words) >= width:
        total = np.zeros(len(words) - width + 1, U64)
        for j in range(width):
            total += words[j : len(words) - width + 1 + j] * PLACES[j]
        inside = np.ones(len(total), bool)
        crossing = (offsets[1:-1, None] - np.arange(1, width)).ravel()
        inside[crossing[(crossing >= 0) & (crossing < len(total))]] = False
        # shingles may also reach from a short row into the next one: those start in a short row
        for size in range(width - 1):
            starts = offsets[:-1][~full & (n > size)] + size
            inside[starts[starts < len(total)]] = False
        regular = np.ones(len(values), bool)
        regular[rows[short]] = False
        values[regular] = mix(total[inside])
    return values, rows


def shingle_sets(column: pa.Array | pa.ChunkedArray, fold: bool = True, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    values, rows = shingle_hashes(*word_hashes(*text_bytes(column), fold), width)
    return [np.unique(values[a:b]) for a, b in zip(rows[:-1], rows[1:])]
