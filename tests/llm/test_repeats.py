import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from lakestrata.llm import repeats
from tests.llm.helpers import AWKWARD, DOCUMENTS, documents, prose, rows


def expected(texts, least=100):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) by marking every repeated string's bytes."""
    seen, out = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        dead = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - least + 1):
            part = data[p : p + least]
            if part in seen:
                dead[p : p + least] = True
            seen.add(part)
        kept = bytes(b for b, d in zip(data, dead) if not d)
        out[i] = (len(data), int(dead.sum()), int((dead[1:] < dead[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


def check(spark, texts, **settings):
    got = {r["doc_id"]: tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows(repeats.repeat_digests(documents(spark, texts).repartition(5), **settings))}
    want = expected(texts, settings.get("least", 100))
    assert got == want
    return want


def passages(seed, count=150):
    draw = random.Random(seed)
    shared = [prose(900 + k, 30) for k in range(6)]
    texts = {}
    for i in range(count):
        text = prose(seed * 1_000 + i, draw.randrange(5, 60))
        for _ in range(draw.randrange(3)):
            passage = draw.choice(shared)
            a, b = sorted((draw.randrange(len(passage)), draw.randrange(len(passage))))
            at = draw.randrange(len(text))
            text = text[:at] + passage[a:b] + text[at:]
        texts[i] = text
    return texts | {count + i: texts[i * 3] for i in range(10)}


def test_against_marking_every_byte(spark):
    want = check(spark, passages(1) | {500: "Der " * 400, 501: "Der " * 60, 502: "é" * 180, 503: "", 504: None, 505: "x" * 99})
    assert sum(w[1] for w in want.values()) > 5_000


def test_short_strings_and_split_groups(spark):
    check(spark, passages(2, 60), least=30, seed=12, chunk=3)
    check(spark, {i: t[:300] for i, t in passages(3, 60).items()}, least=20, seed=20, chunk=1)


def test_awkward_rows(spark):
    docs = documents(spark, AWKWARD + [(11, prose(7, 60)), (12, prose(6, 30_000)[5_000:9_000]), (13, prose(8, 60))])
    docs = docs.withColumn("spans", F.array(F.lit(1))).withColumn("version", F.lit("v")).withColumn("seed", F.lit(2))
    left = repeats.remove_repeats(docs)
    assert left.columns == docs.columns and left.schema == docs.schema
    got = sorted(((r["doc_id"], r["text"]) for r in rows(left)), key=str)
    assert (11, "") in got and (12, "") in got and (13, "") in got  # NULL keys come first
    assert got.count((7, prose(7, 60))) == 2 and (None, prose(8, 60)) in got and (1, None) in got
    same = [(i, t) for i, t in AWKWARD if i not in (9,)]
    assert all(got.count(p) == AWKWARD.count(p) for p in same)
    assert rows(repeats.repeat_digests(spark.createDataFrame([], DOCUMENTS))) == []


def test_one_key_with_two_texts(spark):
    a, b = prose(1, 60), prose(2, 60)
    left = rows(repeats.remove_repeats(documents(spark, [(5, a), (5, b), (6, a + " " + b)])))
    assert sorted(len(r["text"]) for r in left)[1:] == sorted([len(a), len(b)])


def test_intervals():
    found = list(repeats.common_prefix_intervals([3, 5, 5, 2, 4]))
    assert sorted(found) == sorted([(5, 1, 3), (3, 0, 3), (4, 4, 5), (2, 0, 5)])


def test_maximal_repeats_with_all_occurrences():
    texts = [b"xabcabcy", b"zabcabcw", b"qabcq", b"abc"]
    found = {(n, tuple(zip(t.tolist(), at.tolist()))) for n, t, at in repeats.RepeatIndex(texts, np.zeros(4, np.int64), 3).repeats()}
    assert (6, ((0, 1), (1, 1))) in found
    assert (3, ((0, 1), (0, 4), (1, 1), (1, 4), (2, 1), (3, 0))) in found
    assert not any(n == 5 for n, _ in found)  # always after an a, so part of the longer one
    apart = {n for n, _, _ in repeats.RepeatIndex(texts[:2], np.array([0, 1]), 4).repeats()}
    assert apart == set()
