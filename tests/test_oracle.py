"""Every registered query equals its DuckDB twin at sf0.01 (names, row count, values)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE
from recordtable.plans.catalog import ORACLE_SQL, QUERIES
from oracle import compare, duck

NAMES = sorted(QUERIES)  # the queries of recordtable.llm have their tests in tests/llm


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(E.queries()[name](spark, SF_ORACLE), con, E.oracle_sql()[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["p_type", "n", "avg_size", "avg_price"]
    got = df.collect()
    assert len(got) > 0
    assert sum(r["n"] for r in got) == 200
