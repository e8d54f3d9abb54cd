"""The queries of the subpackage over the given tables: against their SQL where there is one."""

import pytest

from lakestrata.llm.queries import QUERIES
from tests.conftest import SF
from tests.oracle import compare, connect

WITH_SQL = sorted(name for name, (_, sql) in QUERIES.items() if sql is not None)


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_against_sql(spark, name):
    query, sql = QUERIES[name]
    assert compare(query(spark, SF), connect(SF), sql) == []


def test_sql_wherever_it_can_say_it():
    assert WITH_SQL == [
        "op11_exact_top_k", "op12_centroid_clustering", "op13_hard_negatives", "op1_url_filters", "op2_quality_rules", "op8_chat_formatting"
    ]
    assert len(QUERIES) == 14


@pytest.mark.parametrize("name", ["op4_document_fingerprints", "op6_token_counts", "op9_sampled_pieces"])
def test_one_row_per_document(spark, name):
    got = QUERIES[name][0](spark, SF)
    assert got.count() == 1_000 and got.select("doc_id").distinct().count() == 1_000
    if name == "op9_sampled_pieces":
        assert got.filter("not lossless").count() == 0
