"""Every registered query of the package itself against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lakestrata.plans.queries import registered
from tests.conftest import SF
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, con, name):
    query, sql = registered()[name]
    assert compare(query(spark, SF), con, sql) == []


def test_all_are_in_the_entry():
    assert set(registered()) <= set(queries()) and set(registered()) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 150
