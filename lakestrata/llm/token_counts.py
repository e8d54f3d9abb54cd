"""Token counts under a unigram model, by dynamic programming shared over a trie of pre-tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.llm.unigram import PRETOKEN, Vocabulary, finder, vocabulary
from lakestrata.llm.words import slices

KNOWN_TOKENS = 400_000
SLICE_BYTES = 1 << 20
#: a longer pre-token shares next to nothing and is scored by itself, in a window of the longest piece
TRIE_DEPTH = 256
PART_CHARS = 1 << 20


class Trie:
    """Counts of pieces by pre-token, scored a set at a time.

    Sorted pre-tokens are the trie: what one has in common with the one before it is their path of
    shared nodes. A node is a prefix with its forward score, the best log-probability of any
    segmentation, and that one's number of pieces (of equally likely ones the fewest). Every node is
    scored once, all nodes of a depth together, in parts of some ``PART_CHARS``. Only the counts at
    the terminals are kept; past ``limit`` of them they are forgotten, which changes no count. So
    memory is bounded beside that of the texts at hand.
    """

    def __init__(self, vocab: Vocabulary, limit: int = KNOWN_TOKENS):
        self.vocab, self.limit = vocab, limit
        self.finder = finder(vocab)
        self.counts: dict[str, int] = {"": 0}
        #: nodes scored so far
        self.scored = 0

    def count(self, tokens: list[str]) -> list[int]:
        """The number of pieces of each pre-token."""
        known = self.counts
        distinct = set(tokens)
        long = {t: self._alone(t) for t in distinct if len(t) > TRIE_DEPTH}
        new = distinct.difference(known, long)
        if len(known) + len(new) > self.limit:
            known.clear()
            known[""] = 0
            new = distinct.difference(known, long)
        chars, part = 0, []
        for token in sorted(new):
            part.append(token)
            chars += len(token)
            if chars > PART_CHARS:
                self._add(part)
                chars, part = 0, []
        if part:
            self._add(part)
        if long:
            return [long[t] if t in long else known[t] for t in tokens]
        return list(map(known.__getitem__, tokens))

    def __getitem__(self, token: str) -> int:
        return self.count([token])[0]

    def _add(self, new: list[str]) -> None:
        size = np.array([len(t) for t in new], np.int64)
        stop = np.cumsum(size)
        begin = stop - size
        text = "".join(new)
        # a character's node: its own place, or that of the first pre-token with the same prefix
        node = np.arange(len(text))
        depth = node - np.repeat(begin, size)
        shared = _common_prefixes(text, begin, size)
        fresh = depth >= np.repeat(shared, size)
        # a shared node's place is that of the last pre-token that had it fresh at this depth
        order = np.lexsort((node, depth))
        last = np.maximum.accumulate(np.where(fresh[order], np.arange(len(order)), 0))
        node[order] = order[last]
        self.scored += int(fresh.sum())
        start, end, _, entry = self.finder.edges(text, np.repeat(stop, size))
        keep = fresh[end]
        start, end, entry = start[keep], end[keep], entry[keep]
        width = np.where(entry >= 0, 1, -entry)
        gain = np.where(entry >= 0, self.finder.logp[np.maximum(entry, 0)], width * self.vocab.fallback)
        first = start == end - depth[end]
        source = node[np.where(first, end, start - 1)]
        order = np.lexsort((end, depth[end]))
        end, gain, width, first, source = (x[order] for x in (end, gain, width, first, source))
        score, pieces = np.zeros(len(text)), np.zeros(len(text), np.int64)
        level = depth[end]
        cuts = np.flatnonzero(np.diff(level)) + 1
        for a, b in zip(np.append(0, cuts).tolist(), np.append(cuts, len(end)).tolist()):
            at = source[a:b]
            total = np.where(first[a:b], 0.0, score[at]) + gain[a:b]
            count = np.where(first[a:b], 0, pieces[at]) + width[a:b]
            heads = np.flatnonzero(np.append(True, end[a + 1 : b] != end[a : b - 1]))
            best = np.maximum.reduceat(total, heads)
            worse = total < np.repeat(best, np.diff(np.append(heads, b - a)))
            ends = end[a:b][heads]
            score[ends] = best
            pieces[ends] = np.minimum.reduceat(np.where(worse, np.iinfo(np.int64).max, count), heads)
        self.counts.update(zip(new, pieces[node[stop - 1]].tolist()))

    def _alone(self, token: str) -> int:
        """The same for one pre-token, with as many scores as the longest piece has characters."""
        vocab, span = self.vocab, self.vocab.longest + 1
        scores, pieces = [float("-inf")] * span, [0] * span
        scores[0] = 0.0
        for start in range(len(token)):
            score, count = scores[start % span], pieces[start % span]
            scores[start % span] = float("-inf")
            single = False
            for end in range(start + 1, min(start + span, len(token) + 1)):
                piece = vocab.prefixes.get(token[start:end])
                if piece is None:
                    break
                if piece >= 0:
                    single |= end == start + 1
                    self._offer(scores, pieces, end % span, score + vocab.logp[piece], count + 1)
            if not single:
                width = len(token[start].encode())
                self._offer(scores, pieces, (start + 1) % span, score + width * vocab.fallback, count + width)
        self.scored += len(token)
        return pieces[len(token) % span]

    @staticmethod
    def _offer(scores: list[float], pieces: list[int], at: int, score: float, count: int) -> None:
        if score > scores[at] or score == scores[at] and count < pieces[at]:
            scores[at], pieces[at] = score, count


def _common_prefixes(text: str, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many characters each sorted pre-token shares with the one before it."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    shared = np.zeros(len(size), np.int64)
    alive = np.arange(1, len(size))
    for depth in range(int(size.max())):
        alive = alive[(size[alive] > depth) & (size[alive - 1] > depth)]
        alive = alive[codes[begin[alive] + depth] == codes[begin[alive - 1] + depth]]
        if not len(alive):
            break
        shared[alive] += 1
    return shared


_tries: dict[str, Trie] = {}


def trie(model: str) -> Trie:
    """One per Python worker, kept from task to task."""
    if model not in _tries:
        _tries[model] = Trie(vocabulary(model))
    return _tries[model]


def count_tokens(documents: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_tokens, n_pretokens)`` for every row of ``documents``, whole texts.

    NULL and empty texts count 0; NULL keys and repeated rows are rows like any; an empty table has
    none. No row moves: each worker shares a trie among the texts of a slice, and the counts of the
    pre-tokens it has met among all.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trie(model)
        for whole in batches:
            for batch in slices(whole, "_text", SLICE_BYTES):
                found = [PRETOKEN.findall(value or "") for value in batch.column("_text").to_pylist()]
                pretokens = np.array([len(f) for f in found], np.int64)
                counts = np.append(0, np.cumsum(np.array(own.count(list(chain.from_iterable(found))), np.int64)))
                ends = np.cumsum(pretokens)
                tokens = counts[ends] - counts[ends - pretokens]
                yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(tokens), pa.array(pretokens)], [key, "n_tokens", "n_pretokens"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInArrow(
        run, f"{key} {kind}, n_tokens long, n_pretokens long"
    )
