import math
import random
import subprocess
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from lakestrata.llm import sampled_pieces, token_counts
from lakestrata.llm.unigram import PRETOKEN, vocabulary
from lakestrata.llm.words import mix
from tests.llm.helpers import AWKWARD, DOCUMENTS, documents, rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(vocab, text):
    if not text:
        yield 0.0, ()
    for k in range(1, min(vocab.longest, len(text)) + 1):
        piece = vocab.ids.get(text[:k])
        if piece is None and k > 1:
            continue
        data = text[:k].encode()
        here = (vocab.logp[piece], (piece,)) if piece is not None else (len(data) * vocab.fallback, tuple(vocab.byte_ids[b] for b in data))
        for p, rest in segmentations(vocab, text[k:]):
            yield here[0] + p, here[1] + rest


def test_counts_are_the_likeliest_segmentation():
    vocab = vocabulary(MODEL)
    trie = token_counts.Trie(vocab, limit=40)
    draw = random.Random(2)
    tokens = ["", " the", " them", " then", "ing", " ing", "日x", "▁", "🙂🙂", "   "] + ["".join(draw.choice(" aeinrt") for _ in range(8)) for _ in range(60)]
    for token in tokens * 2:
        best, ids = min(((-p, len(s)) for p, s in segmentations(vocab, token)))
        assert trie[token] == ids, token
        assert math.isfinite(best)


def test_shared_prefixes_are_scored_once():
    trie = token_counts.Trie(vocabulary(MODEL))
    alone = {t: token_counts.Trie(vocabulary(MODEL))[t] for t in (" tokens", " token", " tokenize", " to", "a tokens")}
    assert trie.count([" tokens", " token", " tokenize", " tokens", " to"]) == [alone[t] for t in (" tokens", " token", " tokenize", " tokens", " to")]
    assert trie.scored == len(" tokens") + len("ize")
    assert trie.count([" to", "a tokens", ""]) == [alone[" to"], alone["a tokens"], 0] and trie.scored == 10 + len("a tokens")


def test_counts_do_not_depend_on_what_is_counted_together(monkeypatch):
    vocab, draw = vocabulary(MODEL), random.Random(4)
    tokens = ["".join(draw.choice(" aeinrtz日é🙂") for _ in range(draw.randrange(1, 30))) for _ in range(400)]
    tokens += [draw.choice("xyz ") * draw.randrange(200, 400) for _ in range(20)] + ["ab" * 3_000, "q" * 257, "q" * 256]
    alone = [token_counts.Trie(vocab)[t] for t in tokens]
    assert token_counts.Trie(vocab).count(tokens) == alone
    monkeypatch.setattr(token_counts, "PART_CHARS", 50)
    assert token_counts.Trie(vocab, limit=30).count(tokens) == alone
    monkeypatch.setattr(token_counts, "TRIE_DEPTH", 2)
    assert token_counts.Trie(vocab).count(tokens) == alone


def test_one_long_text_takes_little_memory():
    """4 MB without a break, in a process of its own."""
    code = f"""
import resource
from lakestrata.llm.token_counts import Trie
from lakestrata.llm.unigram import vocabulary
own = Trie(vocabulary({MODEL!r}))
text = 'x1Zq' * 1_000_000
own['warm up']
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert own[text] > 0
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(done.stdout) < 60


def test_bounds_do_not_depend_on_what_is_filtered_together():
    vocab, draw = vocabulary(MODEL), random.Random(6)
    some = ["".join(draw.choice(" aeinrt") for _ in range(12)) for _ in range(50)] + [" the", "日本", "z" * 90]
    others = list({"".join(draw.choice("abcdefghij ") for _ in range(9)) for _ in range(60_000)})

    def bounds(tokens):
        lattices = sampled_pieces.Lattices(vocab)
        lattices.add(tokens)
        first, edges, _, _ = lattices.arrays()
        found = {}
        for t in some:
            node = lattices.end[t]
            stop = first[node + 1] if node + 1 < len(first) else len(edges)
            found[t] = edges[first[node] : stop].tolist()
        return found

    alone = {}
    for t in some:
        lattices = sampled_pieces.Lattices(vocab)
        lattices.add([t])
        first, edges, _, _ = lattices.arrays()
        alone[t] = edges[first[lattices.end[t]] :].tolist()
    assert bounds(some + others) == alone


def test_counts_of_awkward_tables(spark):
    got = rows(token_counts.count_tokens(documents(spark, AWKWARD), MODEL))
    trie = token_counts.Trie(vocabulary(MODEL))
    want = sorted((str(i), sum(trie[t] for t in PRETOKEN.findall(x or ""))) for i, x in AWKWARD)
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == want
    assert rows(token_counts.count_tokens(spark.createDataFrame([], DOCUMENTS), MODEL)) == []


@pytest.mark.parametrize("token", [" thes", "ng🙂", "ander", " x▁"])
def test_draws_follow_the_posterior(token):
    vocab = vocabulary(MODEL)
    chances = Counter()
    for p, ids in segmentations(vocab, token):
        chances[ids] += math.exp(0.5 * p)
    total = sum(chances.values())
    n = 40_000
    ids, at = sampled_pieces.sample(sampled_pieces.Lattices(vocab), [token] * n, mix(np.arange(n, dtype=np.uint64)))
    drawn = Counter(tuple(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:]))
    assert set(drawn) <= set(chances)
    for s, weight in chances.items():
        assert abs(drawn[s] / n - weight / total) < 0.012


def test_long_tokens_keep_their_precision():
    vocab = vocabulary(MODEL)
    texts = ["ab" * 4_000, "ab", "日" * 300 + "q" * 700, " " * 1_000 + "z"]
    ids, at = sampled_pieces.sample(sampled_pieces.Lattices(vocab), texts, mix(np.arange(4, dtype=np.uint64)))
    assert [vocab.decode(ids[a:b].tolist()) for a, b in zip(at[:-1], at[1:])] == texts


def test_encoding_is_lossless_and_reproducible(spark):
    docs = documents(spark, AWKWARD)
    first = sampled_pieces.sampled_encoding(docs, MODEL)
    got = sorted(((r["doc_id"], r["ids"], r["lossless"], r["n_pieces"]) for r in rows(first)), key=str)
    again = sorted(((r["doc_id"], r["ids"], r["lossless"], r["n_pieces"]) for r in rows(sampled_pieces.sampled_encoding(docs.repartition(5), MODEL))), key=str)
    other = sorted(((r["doc_id"], r["ids"]) for r in rows(sampled_pieces.sampled_encoding(docs, MODEL, seed=1))), key=str)
    assert got == again and [g[:2] for g in got] != other
    assert all(g[2] and g[3] == len(g[1]) for g in got)
    texts = sorted(((r["doc_id"], r["text"]) for r in rows(sampled_pieces.decode_pieces(first, MODEL))), key=str)
    assert texts == sorted(((i, t or "") for i, t in AWKWARD), key=str)
    assert rows(sampled_pieces.sampled_encoding(spark.createDataFrame([], DOCUMENTS), MODEL)) == []
