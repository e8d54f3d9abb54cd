import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import near_dedup, quality_rules, repeats
from lakestrata.llm.components import components
from lakestrata.llm.words import shingle_sets
from lakestrata.session import scratch_root
from lakestrata.sources import fs
from tests.conftest import SMALL
from tests.llm.helpers import AWKWARD, DOCUMENTS, FOLD, WORD, documents, prose, rows


def shingles(text):
    words = WORD.findall((text or "").translate(FOLD))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def expected(texts, percent=85):
    """Component by id, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in texts}
    ids = sorted(texts)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {x: new if y == old else y for x, y in label.items()}
    return label, sets


def edited(text, edits, draw):
    words = text.split()
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"e{draw.randrange(40)}"
    return " ".join(words)


def check(spark, texts, percent=85):
    want, sets = expected(texts, percent)
    got = {r["doc_id"]: r for r in rows(near_dedup.near_duplicates(documents(spark, texts), percent=percent))}
    assert {i: r["component_id"] for i, r in got.items()} == want
    for i, r in got.items():
        assert r["n_shingles"] == len(sets[i]) and r["kept"] == (want[i] == i)


def test_against_all_pairs(spark):
    draw = random.Random(2)
    base = [prose(1, 150), prose(2, 150), prose(3, 30)]
    texts = {i: edited(draw.choice(base), draw.randrange(5), draw) for i in range(220)}
    texts |= {300: "", 301: None, 302: " \n", 303: "a", 304: "A", 305: "a b c d e", 306: "a b c d E f", 307: texts[4].upper()}
    check(spark, texts)
    check(spark, {i: t for i, t in texts.items() if i % 3 == 0}, 80)


def test_links_between_members_far_from_their_leader(spark):
    """A family whose members link with one another and not with the group's least member."""
    draw = random.Random(7)
    base = prose(5, 200)
    branch = edited(base, 12, draw)
    texts = {0: base} | {i: edited(base, 6, draw) for i in range(1, 60)} | {i: edited(branch, 1, draw) for i in range(60, 100)}
    check(spark, texts)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4_000)
    monkeypatch.setattr(near_dedup, "CHUNK_MEMBERS", 7)
    test_links_between_members_far_from_their_leader(spark)


def test_given_texts(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    got = {r["doc_id"]: r["component_id"] for r in rows(near_dedup.near_duplicates(table))}
    assert got == expected(texts)[0]


def test_awkward_tables(spark):
    docs = documents(spark, AWKWARD + [(20, prose(7, 60)), (21, prose(6, 30_000))]).withColumn("kept", F.lit("x")).withColumn("band", F.lit(1))
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in rows(near_dedup.near_duplicates(docs))), key=str)
    assert (20, 7, False) in got and got.count((7, 7, True)) == 2 and (21, 6, False) in got and got.count((None, None, True)) == 2
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(AWKWARD)
    assert rows(near_dedup.near_duplicates(spark.createDataFrame([], DOCUMENTS))) == []


def test_other_texts_under_the_key_of_a_copy_stay(spark):
    copied, other = prose(31, 80), prose(32, 80)
    docs = documents(spark, [(1, copied), (2, copied), (2, other), (3, other + " end"), (4, copied), (None, copied)])
    left = sorted(((r["doc_id"], r["text"]) for r in rows(near_dedup.drop_near_duplicates(docs))), key=str)
    texts = {(i, t) for i, t in left}
    assert (1, copied) in texts and (4, copied) not in texts and (None, copied) in texts
    # of the two texts under 2 one was compared; no text is lost altogether
    assert (2, other) in texts or (3, other + " end") in texts and {t for _, t in texts} >= {copied}


@pytest.mark.parametrize("names", [["_gone", "_gone_version", "version", "band"], ["_key", "_text", "_version", "_spans"], ["column_0", "column_1", "kept", "compared"]])
def test_columns_may_have_any_name(spark, names):
    """All stages that return whole rows."""
    docs = documents(spark, {1: prose(31, 80), 2: prose(31, 80), 3: prose(32, 80)})
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(f"x{i}"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for made, ids in (
        (near_dedup.drop_near_duplicates(docs), [1, 3]), (repeats.remove_repeats(docs), [1, 2, 3]), (quality_rules.keep_documents(docs, labels), [1, 2, 3])
    ):
        assert made.columns == docs.columns
        got = rows(made)
        assert sorted(r["doc_id"] for r in got) == ids and all(r[n] == f"x{i}" for r in got for i, n in enumerate(names))


def test_signatures_are_unbiased():
    a, b = (shingle_sets(pa.array([" ".join(f"w{k}" for k in range(s, s + 504))]))[0] for s in (0, 100))
    joined, starts = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
    signature = near_dedup._permuted(joined, starts, 600)
    assert abs((signature[0] == signature[1]).mean() - 400 / 600) < 0.06


def test_components_of_awkward_graphs(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1_000, 1_000 + i) for i in range(40)] + [(7, 7), (None, 3), (2_000, 1_999), (1_999, 2_000)]
    got = {r["node"]: r["component"] for r in rows(components(spark.createDataFrame(edges, "a long, b long"), "a", "b"))}
    assert got == {i: 0 for i in range(51)} | {1_000 + i: 1_000 for i in range(40)} | {1_999: 1_999, 2_000: 1_999}
    assert rows(components(spark.createDataFrame([], "a long, b long"), "a", "b")) == []


def test_steps_of_components_write_few_files(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(300) if n % 30], "a long, b long")
    root = f"{scratch_root(spark)}/lakestrata/{spark.sparkContext.applicationId}"
    known = set(fs.list_names(spark, root))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    kept = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        got = {r["node"]: r["component"] for r in components(edges, "a", "b").collect()}
    finally:
        spark.conf.set(conf, kept)
    assert got == {n: n - (n - 1) % 30 for n in range(1, 301)}
    written = [
        sum(n.endswith(".parquet") for n in fs.list_names(spark, f"{root}/{folder}"))
        for folder in set(fs.list_names(spark, root)) - known
        if folder.startswith("edges-")
    ]
    assert len(written) > 2 and sorted(written)[:-1] == [1] * (len(written) - 1)  # all but the given edges
