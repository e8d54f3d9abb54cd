import math
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import quality_rules
from tests.conftest import SMALL
from tests.llm.helpers import AWKWARD, DOCUMENTS, WORD, documents, prose, rows


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = {w: windows.count(w) for w in set(windows)} if len(windows) < 500 else {}
    covered = {i + k for i, w in enumerate(windows) if count.get(w, 0) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_counts_against_brute_force(spark):
    draw = random.Random(3)
    texts = {i: t for i, (_, t) in enumerate(AWKWARD) if len(t or "") < 5_001}
    for i in range(100, 160):
        texts[i] = "".join(draw.choice(["a", "b", " ", "\n", "#", "é", "\t"]) for _ in range(draw.randrange(80)))
    got = {r["doc_id"]: r for r in rows(quality_rules.text_features(documents(spark, texts), "text", ["doc_id"]))}
    for i, text in texts.items():
        want = expected(text)
        assert tuple(got[i][c] for c in COUNTS) == want, repr(text)[:80]
        assert got[i]["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_windows_of_equal_hash_are_compared_by_words(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "_hash_of", lambda packed: packed * 0)
    texts = {1: "a b c d e f g h", 2: "a b c d a b c e f", 3: "a a a a", 4: "x y", 5: "b c a b c a d e f b c"}
    for r in rows(quality_rules.text_features(documents(spark, texts), "text", ["doc_id"])):
        assert tuple(r[c] for c in COUNTS) == expected(texts[r["doc_id"]])


def test_counts_on_given_texts(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect() if len(r["text"]) < 2_000}
    for r in rows(quality_rules.text_features(table, "text", ["doc_id"])):
        if r["doc_id"] in texts:
            assert tuple(r[c] for c in COUNTS) == expected(texts[r["doc_id"]])


@pytest.mark.parametrize("rejected,good,risk", [(0, 300, 0.01), (3, 500, 0.01), (40, 5_000, 0.01), (0, 0, 0.01), (90, 20_000, 0.005), (2, 60, 0.3)])
def test_binomial_tail_is_exact(spark, rejected, good, risk):
    df = spark.createDataFrame([(rejected, good)], "rejected long, good long")
    got = df.select(quality_rules._binomial_tail(F.col("rejected"), F.col("good"), risk).alias("p")).first()["p"]
    log = [math.lgamma(good + 1) - math.lgamma(i + 1) - math.lgamma(good - i + 1) + i * math.log(risk) + (good - i) * math.log(1 - risk) for i in range(rejected + 1)]
    assert got == pytest.approx(sum(map(math.exp, log)), rel=1e-9)


def test_cutoffs_against_brute_force(spark):
    grids = {"a": (0.9, 0.5, 0.1), "b": (0.8, 0.4)}
    draw = random.Random(5)
    rows_in = []
    for stratum, n, tail in (("big", 2_000, 0.002), ("dirty", 2_000, 0.2), ("small", 40, 0.0)):
        rows_in += [(stratum, draw.random() if draw.random() < tail else 0.05, 0.0) for _ in range(n)]
    good = spark.createDataFrame(rows_in, "stratum string, a double, b double")
    got = {(r["stratum"], r["metric"]): r["cutoff"] for r in rows(quality_rules.risk_controlled_cutoffs(good, "stratum", grids, 0.04, 0.95))}
    for stratum in ("big", "dirty", "small"):
        for k, (metric, grid) in enumerate(grids.items(), 1):
            values = [r[k] for r in rows_in if r[0] == stratum]
            want = None
            for cutoff in grid:
                bad, n = sum(v > cutoff for v in values), len(values)
                p = sum(math.comb(n, i) * 0.02**i * 0.98 ** (n - i) for i in range(bad + 1))
                if p > 0.05 / 6:
                    break
                want = cutoff
            assert got[stratum, metric] == want, (stratum, metric)
    assert got["big", "a"] == 0.1 and got["small", "a"] is None and got["dirty", "a"] != 0.1


def test_verdicts(spark):
    clean = [(i, prose(i, 80)) for i in range(2_200)]
    junk = [(5_000 + i, " ".join(w + "###" for w in prose(i, 80).split())) for i in range(20)]
    docs = documents(spark, clean + junk + [(None, prose(1, 60)), (None, "###" * 100), (7, None)]).withColumn("kept", F.lit(1))
    labels = spark.createDataFrame([(i, 1) for i in range(2_200)] + [(5_000, 0), (None, 1), (99_999, 1), (3, 0)], "doc_id long, quality long")
    got = rows(quality_rules.judge_documents(docs.drop("kept"), labels))
    assert len(got) == 2_223
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] != 7:
            assert r["kept"] == (r["doc_id"] < 5_000)
    left = quality_rules.keep_documents(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == list(range(2_200))
    assert left.filter("doc_id is null").count() == 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    labels = spark.createDataFrame([], "doc_id long, quality long")
    assert rows(quality_rules.judge_documents(none, labels)) == []
    assert quality_rules.keep_documents(documents(spark, {1: prose(1, 80)}), labels).count() == 1


def test_metrics_of_odd_texts(spark):
    texts = {1: "no no no! NO!", 2: "", 3: None, 4: "!!", 5: "a b a b"}
    got = {r["doc_id"]: r for r in rows(quality_rules.text_features(documents(spark, texts), "text", ["doc_id"]))}
    assert [got[i]["same_word_share"] for i in texts] == [0.25, 0, 0, 0, 0]
    assert [got[i]["bang_share"] for i in texts] == [2 / 10, 0, 0, 1, 0]


def test_cutoffs_go_on_until_the_test_fails(spark):
    """No metric stops short of the strictest cutoff that the holdout proves."""
    good = spark.createDataFrame([(i % 1500 == 0,) for i in range(3_000)], "odd boolean")
    shares = good.select(F.lit("en").alias("lang"), *(F.when(F.col("odd"), 0.5).otherwise(0.005).alias(m) for m in quality_rules.GRIDS))
    got = rows(quality_rules.risk_controlled_cutoffs(shares, "lang"))
    clean = rows(quality_rules.risk_controlled_cutoffs(shares.replace(0.005, 0.0), "lang"))
    assert {(r["metric"], r["cutoff"]) for r in got} == {(m, 0.01) for m in quality_rules.GRIDS}
    assert {(r["metric"], r["cutoff"]) for r in clean} == {(m, 0.0) for m in quality_rules.GRIDS}
