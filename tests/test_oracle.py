"""Every registered query with SQL gives what DuckDB gives; the others give rows."""

import pytest
from conftest import TABLES
from oracle_compare import compare, connect

from skygalley.registry import oracle_sql, queries

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(TABLES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, TABLES), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_has_rows(spark, name):
    df = QUERIES[name](spark, TABLES)
    assert len(set(df.columns)) == len(df.columns)
    assert df.limit(1).count() == 1
