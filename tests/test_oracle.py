"""Every registered query that has SQL returns what DuckDB returns, on whole tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle_check import compare, connect

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF_DIR), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_sql_belongs_to_queries():
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["business_id", "distance"] and df.count() == 5
