"""A public SentencePiece vocabulary seen as a unigram model: pieces with chances by Zipf's law of their rank."""

from __future__ import annotations

import math
import re

import numpy as np

from lakestrata.llm.words import _tables, mix

#: Runs that no piece crosses: spaces belong to the word after them, and no piece holds a line break.
PRETOKEN = re.compile(r" *[^ \n]+| +|\n")
RANK_SHIFT = 10.0
FALLBACK_LOSS = 10.0
U64 = np.uint64
SLOT_BITS = 20


class Vocabulary:
    """``ids`` by piece text (with real spaces), ``logp`` by id, ``content`` bytes by id.

    Characters that are no piece are their UTF-8 bytes' pieces, at ``fallback`` for each. The
    control pieces take no part. A literal U+2581 in a text is such a character, since pieces hold
    real spaces here; so every text is a sequence of pieces and comes back from it unchanged.
    """

    def __init__(self, model: str):
        import sentencepiece

        loaded = sentencepiece.SentencePieceProcessor(model_file=model)
        self.ids: dict[str, int] = {}
        self.byte_ids = [0] * 256
        size = loaded.get_piece_size()
        self.content = [b""] * size
        ranks = {}
        for i in range(size):
            name = loaded.id_to_piece(i)
            if loaded.is_byte(i):
                self.byte_ids[int(name[3:-1], 16)] = i
                self.content[i] = bytes([int(name[3:-1], 16)])
            elif not (loaded.is_control(i) or loaded.is_unknown(i)):
                piece = name.replace("▁", " ")
                self.ids[piece] = i
                self.content[i] = piece.encode()
                ranks[i] = -loaded.get_score(i)
        total = sum(1 / (r + RANK_SHIFT) for r in ranks.values())
        self.logp = {i: -math.log((r + RANK_SHIFT) * total) for i, r in ranks.items()}
        self.fallback = min(self.logp.values()) - FALLBACK_LOSS
        # every prefix of a piece, with the piece's id or -1
        self.prefixes: dict[str, int] = {}
        for piece, i in self.ids.items():
            for k in range(1, len(piece)):
                self.prefixes.setdefault(piece[:k], -1)
            self.prefixes[piece] = i
        self.suffixes = {piece[k:] for piece in self.ids for k in range(len(piece))}
        sizes = np.array([len(c) for c in self.content], np.int64)
        #: all contents in a row, and where each begins and how long it is
        self.contents = np.frombuffer(b"".join(self.content), np.uint8), np.cumsum(sizes) - sizes, sizes
        self.longest = max(map(len, self.ids))

    def decode(self, ids) -> str:
        return b"".join(map(self.content.__getitem__, ids)).decode()


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model: str) -> Vocabulary:
    """One per Python worker."""
    if model not in _loaded:
        _loaded[model] = Vocabulary(model)
    return _loaded[model]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class _Sums:
    """Hashes of any part of a text in one step each, from running sums over its characters."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _tables(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(mix(codes.astype(U64) + U64(1)) * up[: len(codes)], out=self.sums[1:])

    def part(self, start: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.down[start]


class PieceFinder:
    """All pieces in a text at once, by hashes of its parts.

    An entry is a prefix of a piece; ``piece`` has the piece's id or -1, ``logp`` its log-probability.
    """

    def __init__(self, vocab: Vocabulary):
        self.longest = vocab.longest
        prefixes = list(vocab.prefixes.items())
        hashes = np.concatenate([_Sums(_codes(p)).part(np.zeros(1, np.int64), len(p)) for p, _ in prefixes])
        order = np.argsort(hashes)
        self.known = hashes[order]
        # where the hashes with the same leading bits begin, and the most that share them
        slots = np.searchsorted(self.known >> U64(64 - SLOT_BITS), np.arange((1 << SLOT_BITS) + 1, dtype=U64))
        self.slots = slots[:-1].astype(np.int32)
        self.most = int(np.diff(slots).max())
        self.known = np.append(self.known, np.full(self.most, self.known[-1]))
        self.piece = np.array([i for _, i in prefixes], np.int32)[order]
        self.logp = np.array([vocab.logp.get(i, -math.inf) for i in self.piece.tolist()])

    def edges(self, text: str, stops: np.ndarray) -> tuple[np.ndarray, ...]:
        """Start, last character, id and entry of every piece in the joined pre-tokens of ``text``,
        none across its character's ``stops``.

        A character that is no piece itself is an edge with id -1 - c and, as its entry, minus the
        number of its bytes.
        """
        codes = _codes(text)
        sums = _Sums(codes)
        alive = np.arange(len(codes))
        single = np.zeros(len(codes), bool)
        found = []
        for length in range(1, self.longest + 1):
            alive = alive[alive + length <= stops[alive]]
            part = sums.part(alive, length)
            at = self.slots[part >> U64(64 - SLOT_BITS)]
            hit = self.known[at] == part
            for k in range(1, self.most):
                later = self.known[at + k] == part
                at = np.where(later & ~hit, at + k, at)
                hit |= later
            alive, at = alive[hit], np.minimum(at[hit], len(self.piece) - 1)
            whole = self.piece[at] >= 0
            if length == 1:
                single[alive[whole]] = True
            found.append((alive[whole], alive[whole] + length - 1, self.piece[at[whole]], at[whole].astype(np.int64)))
        odd = np.flatnonzero(~single)
        width = 1 + (codes[odd] >= 0x80).astype(np.int64) + (codes[odd] >= 0x800) + (codes[odd] >= 0x10000)
        found.append((odd, odd, -1 - codes[odd].astype(np.int64), -width))
        return tuple(np.concatenate(c) for c in zip(*found))


_finders: dict[int, PieceFinder] = {}


def finder(vocab: Vocabulary) -> PieceFinder:
    """One per vocabulary and Python worker."""
    if id(vocab) not in _finders:
        _finders[id(vocab)] = PieceFinder(vocab)
    return _finders[id(vocab)]
