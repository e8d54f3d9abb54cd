import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakestrata.llm import packing
from tests.llm.helpers import AWKWARD, DOCUMENTS, documents, prose, rows

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def whole_ids(text):
    return [*Tokenizer.from_file(FILES[0]).encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_the_tokenizer():
    draw = random.Random(1)
    encoder = packing.Encoder(*FILES)
    full = Tokenizer.from_file(FILES[0])
    parts = ["a", "The", " ", "  ", "\n", "\t", " ", "é", "’s", "'s", "日本", "🙂", "1", "²", "<|endoftext|>", "#", " ", "\x1c", "x́", "\r\n"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(3_000)]
    for text in texts + [t or "" for _, t in AWKWARD if len(t or "") < 10_000]:
        want = full.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want, repr(text)


@pytest.mark.parametrize("run", [" ", "\n", "\t\u3000 \r\n", "x", "ab1"])
def test_long_runs_equal_the_tokenizer(run):
    """2 million blanks, or many letters, alone and between words."""
    encoder, full = packing.Encoder(*FILES), Tokenizer.from_file(FILES[0])
    long = run * ((2_000_000 if run.isspace() else 200_000) // len(run))
    for text in (long, f"one two{long}three four", f"one {long}"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == full.encode(text, add_special_tokens=False).ids


def check(spark, pairs):
    got = rows(packing.pack_documents(documents(spark, pairs).withColumn("offset", F.lit(1)), *FILES, with_ids=True))
    by_document = {}
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] <= 4 * 2048
        by_document.setdefault(r["doc_id"], []).append(r)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    for key, text in dict(pairs).items():
        pieces = sorted(by_document[key], key=lambda r: r["piece"])
        if [k for k, _ in pairs].count(key) == 1:
            ids = b"".join(r["ids"] for r in pieces)
            assert np.frombuffer(ids, "<u4").tolist() == whole_ids(text)
            assert [r["start"] for r in pieces] == np.cumsum([0] + [r["length"] for r in pieces[:-1]]).tolist()
            assert all(r["length"] == 2048 for r in pieces[1:])
    return got, bins


def test_packing(spark):
    got, bins = check(spark, [(i, prose(i, random.Random(i).randrange(1, 900))) for i in range(300)])
    assert len(bins) <= 1.03 * sum(r["length"] for r in got) / 2048 + 1


def test_awkward_tables(spark):
    got, _ = check(spark, AWKWARD)
    assert sum(r["doc_id"] == 7 for r in got) == 2
    assert rows(packing.pack_documents(spark.createDataFrame([], DOCUMENTS), *FILES)) == []


def test_sequences_hold_their_pieces(spark):
    packed = packing.pack_documents(documents(spark, {i: prose(i, 90) for i in range(40)}), *FILES, with_ids=True)
    made = {r["sequence_id"]: r for r in rows(packing.sequences(packed))}
    for r in rows(packed):
        ids = bytes(made[r["sequence_id"]]["ids"])
        assert ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == bytes(r["ids"])
        assert len(ids) == 4 * made[r["sequence_id"]]["n_ids"]


def test_each_piece_goes_where_the_squares_become_least():
    draw = random.Random(4)
    lengths = np.array([draw.randrange(1, 21) for _ in range(400)])
    bins, offsets = packing.sum_of_squares(lengths, 20)
    gaps: dict[int, int] = {}

    def squares(state):
        open_gaps = [g for g in state.values() if g]
        return sum(open_gaps.count(g) ** 2 for g in set(open_gaps))

    for s, to, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        options = [squares(gaps | {b: g - s}) for b, g in gaps.items() if g >= s] + [squares(gaps | {-1: 20 - s})]
        assert offset == 20 - gaps.get(to, 20)
        gaps[to] = gaps.get(to, 20) - s
        assert squares(gaps) == min(options) and gaps[to] >= 0
