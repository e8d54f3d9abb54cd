import corpus_pipeline
from lakestrata.llm import packing
from tests.conftest import SMALL
from tests.llm.helpers import documents, prose
from tests.llm.test_near_dedup import expected as near
from tests.llm.test_repeats import expected as repeated


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, seen[-1], SMALL)
        assert made.columns == docs.columns
        seen.append(spark.createDataFrame(made.collect(), docs.schema))
    texts = [{r["doc_id"]: r["text"] for r in d.collect()} for d in seen]
    assert set(texts[4]) == set(texts[3]) < set(texts[2]) <= set(texts[1]) < set(texts[0])
    label = near(texts[2], 80)[0]
    assert set(texts[3]) == {i for i, c in label.items() if i == c}
    for i, (size, removed, *_) in repeated(texts[3]).items():
        assert size - removed - 3 <= len(texts[4][i].encode()) <= size - removed
    good = {r["doc_id"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1").collect()}
    lost = [i for i in good & set(texts[0]) if i not in texts[2] and len(texts[0][i].split()) >= 50]
    assert len(lost) <= 0.03 * len(good)
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).select("doc_id").collect()}
    assert got == set(texts[4])
    assert packing.CAPACITY == 2048


def test_stages_over_no_and_odd_documents(spark):
    for docs in (documents(spark, {}), documents(spark, [(1, None), (1, None), (None, prose(3, 70)), (5, "")])):
        for _, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SMALL)
            assert made.count() >= 0
