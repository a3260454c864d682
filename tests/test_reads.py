"""Reads: search modes, limits, bound SQL parameters, counts, stats."""

import pytest

from conftest import SF_SMALL, rows
from recordtable.operators.read import count_rows, find, group_stats, key_counts, list_rows, lookup, run_sql


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(
        [(1, "Anti-Mage"), (2, "anti_x"), (3, "Axe"), (4, None), (5, "50% off"), (6, "it's"), (7, "a\\b")],
        "id int, name string",
    )


def test_find_like_wildcards(names):
    assert [r.id for r in find(names, "name", "a_t", key="id").collect()] == [2]
    assert [r.id for r in find(names, "name", "nti", key="id").collect()] == [1, 2]


def test_find_literal_keeps_wildcards_literal(names):
    assert [r.id for r in find(names, "name", "a_t", mode="literal", key="id").collect()] == []
    assert [r.id for r in find(names, "name", "0%", mode="literal", key="id").collect()] == [5]


def test_find_ignore_case(names):
    assert [r.id for r in find(names, "name", "ANTI", mode="literal", ignore_case=True, key="id").collect()] == [1, 2]
    assert find(names, "name", "ANTI", mode="literal").count() == 0


def test_find_quote_is_data_not_sql(names):
    assert [r.id for r in find(names, "name", "it's").collect()] == [6]


def test_find_backslash_is_data(names):
    assert [r.id for r in find(names, "name", "a\\b").collect()] == [7]
    assert [r.id for r in find(names, "name", "\\").collect()] == [7]


def test_list_rows_nulls_first_key_tiebreak(names):
    got = list_rows(names, ["id", "name"], ["name"], 3, key="id").collect()
    assert [r.id for r in got] == [4, 5, 1]


@pytest.mark.parametrize("bad", [-1, "5", 2.0, True])
def test_list_rows_rejects_bad_limit(names, bad):
    with pytest.raises(ValueError):
        list_rows(names, ["id"], ["name"], bad)


def test_lookup_value_and_keys(spark, names):
    assert lookup(names, "id", 3).collect()[0].name == "Axe"
    keys = spark.createDataFrame([(1,), (1,), (9,)], "id int")
    assert rows(lookup(names, "id", keys=keys)) == [(1, "Anti-Mage")]
    with pytest.raises(ValueError):
        lookup(names, "id")


def test_run_sql_binds_parameters(spark, names):
    df = run_sql(spark, "SELECT id FROM t WHERE name = :n", views={"t": names}, args={"n": "it's"})
    assert [r.id for r in df.collect()] == [6]


def test_group_stats_null_key_and_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5), ("b", None)], "g string, x int")
    got = group_stats(df, "g", ["x"]).collect()
    assert [(r.g, r.n, r.avg_x) for r in got] == [("a", 2, 2.0), (None, 1, 5.0), ("b", 1, None)]


def test_counts(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    assert count_rows(orders).collect()[0].rows == orders.count()
    for bound in (2_000_000, None):
        kc = key_counts(orders, "o_custkey", customer, "c_custkey", max_broadcast_rows=bound)
        assert kc.count() == customer.count()
        assert kc.agg({"n": "sum"}).collect()[0][0] == orders.join(customer, orders.o_custkey == customer.c_custkey).count()
