import hashlib

import numpy as np
import pytest

from lakestrata.llm.fingerprints import Sketch, compare_with_edits, fingerprint, merge_fingerprints
from tests.llm.helpers import AWKWARD, DOCUMENTS, WORD, documents, prose, rows


def shingles(text):
    words = WORD.findall(text or "")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_neighbours_and_edits(spark):
    texts = {i * 3: prose(i, 20 + i) for i in range(100)} | {1: None, 4: "", 5: "a", 8: "é🙂" * 30, 301: prose(99, 119)}
    got = {r["doc_id"]: r for r in rows(compare_with_edits(documents(spark, texts)))}
    order = sorted(texts)
    assert sorted(got) == order
    for i, following in zip(order, order[1:] + order[:1]):
        text, after = texts[i] or "", texts[following] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i]["near_edited"] == pytest.approx(likeness(text, edited))  # sets this small are whole
        assert got[i]["near_next"] == pytest.approx(likeness(text, after))
        assert got[i]["shingles"] == len(shingles(text))
    assert got[297]["fingerprint"] == got[301]["fingerprint"]  # equal texts


def test_awkward_tables(spark):
    got = rows(compare_with_edits(documents(spark, AWKWARD)))
    assert len(got) == len(AWKWARD)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 7}) == 1
    alone = rows(compare_with_edits(documents(spark, {5: "a b c d e f"})))
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert rows(compare_with_edits(spark.createDataFrame([], DOCUMENTS))) == []
    assert len(rows(compare_with_edits(documents(spark, [(None, "x"), (None, "y")])))) == 2


def test_estimates_of_large_sets():
    draw = np.random.RandomState(4)
    pool = np.unique(draw.randint(0, 2**63, 60_000, dtype=np.int64).astype(np.uint64) * np.uint64(2))
    a, b = Sketch(pool[np.sort(draw.permutation(len(pool))[:40_000])]), Sketch(pool[np.sort(draw.permutation(len(pool))[:40_000])])
    assert a.count() == pytest.approx(40_000, rel=0.25)
    assert a.resemblance(b) == pytest.approx(0.5, abs=0.15)
    assert a.containment(b) == pytest.approx(0.67, abs=0.2)
    assert (Sketch.read(a.text()).least == a.least).all()


def test_parts_merge_to_the_sketch_of_the_whole(spark):
    parts = [prose(k, 300, kinds=90) for k in range(20)]
    whole = documents(spark, {1: " | ".join(parts)})
    frame = fingerprint(documents(spark, dict(enumerate(parts)))).selectExpr("1L as doc_id", "fingerprint")
    merged = Sketch.read(rows(merge_fingerprints(frame, "doc_id"))[0]["fingerprint"])
    one = Sketch.read(rows(fingerprint(whole))[0]["fingerprint"])
    assert merged.resemblance(one) > 0.85  # but for the shingles across the joints
    again = merge_fingerprints(frame.unionByName(frame).repartition(7), "doc_id")
    assert rows(again)[0]["fingerprint"] == merged.text()
