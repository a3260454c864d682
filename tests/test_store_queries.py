"""The stored-table queries on rows that leave some keys of every kind: the delete takes the customers of all orders."""

import pytest

import __spark_entry__ as E
from oracle import duck

SEGMENTS = ("BUILDING", "MACHINERY", "AUTOMOBILE")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("store"))

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")

    write("supplier", [(k, f"s{k}", k, k / 2) for k in range(4)],
          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double")
    write("customer", [(k, f"c{k}", k, k / 4, SEGMENTS[k % 3]) for k in range(2, 14)],
          "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    write("events", [(i, k, t) for i, (k, t) in enumerate([(0, "view"), (4, "click"), (5, "view"), (5, "click"), (99, "view")])],
          "event_id long, user_id long, event_type string")
    # customers of every segment, a supplier that is no customer, a key that is in no table
    write("orders", [(i, k) for i, k in enumerate([3, 3, 6, 7, 8, 1, 500])], "o_orderkey long, o_custkey long")
    return d


WANT = {
    (0, "view", 0, 0.0), (2, "s2", 2, 1.0), (4, "click", 4, 1.0), (5, "click", 5, 1.25),
    (9, "c9", 9, 2.25), (10, "c10", 10, 2.5), (11, "c11", 11, 2.75), (12, "c12", 12, 3.0), (13, "c13", 13, 3.25),
}


def test_store_flat_deletes_the_customers_of_all_orders(spark, tables):
    assert {tuple(r) for r in E.queries()["store_flat"](spark, tables).collect()} == WANT


def test_store_bucketed_deletes_the_customers_of_all_orders(spark, tables):
    assert {tuple(r) for r in E.queries()["store_bucketed"](spark, tables).collect()} == WANT


def test_store_bucketed_sql_deletes_the_customers_of_all_orders(tables):
    assert set(duck(tables).execute(E.oracle_sql()["store_bucketed"]).fetchall()) == WANT
