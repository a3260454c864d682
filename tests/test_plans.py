"""Physical plan shapes: pushdown, pruning, broadcast only behind a bounded count, partial aggregation."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recordtable.operators.change import delete
from recordtable.operators.joins import bounded_bytes, bounded_rows
from recordtable.plans import catalog as C


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_pushes_key_filter_to_scan(spark):
    p = plan(C.q_lookup(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(c_custkey), EqualTo(c_custkey,42)]" in p


def test_list_rows_is_top_n_with_pruned_scan(spark):
    p = plan(C.q_list_rows(spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=50" in p
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_size:int>" in p


def test_find_literal_pushes_contains(spark):
    p = plan(C.q_find_like(spark, SF_SMALL))
    assert "StringContains(p_name,old w)" in p


def test_group_stats_partial_aggregation(spark):
    p = plan(C.q_group_stats(spark, SF_SMALL))
    assert "partial_count(1)" in p and "partial_avg(p_size" in p


def test_delete_broadcasts_small_key_set_and_never_shuffles_table(spark):
    p = plan(C.q_delete(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LeftAnti, BuildRight" in p
    assert "SortMergeJoin" not in p


def test_large_change_set_is_not_broadcast(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    customer = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    # bound smaller than the key set, no bitmaps: no broadcast, shuffle join instead
    result, _ = delete(orders, customer, "o_custkey", "c_custkey", max_broadcast_rows=10, max_bitmaps=0)
    p = plan(result)
    assert "BroadcastExchange" not in p and "SortMergeJoin" in p


def test_bounded_rows(spark):
    df = spark.range(0, 1000)
    assert bounded_rows(df, 5) is None
    assert bounded_rows(df, 1000) == 1000


def test_bounded_bytes(spark):
    narrow = spark.range(0, 1000)
    wide = narrow.select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    assert bounded_bytes(narrow, 100_000) and not bounded_bytes(wide, 1_000_000)


def test_upsert_winner_needs_no_window(spark):
    p = plan(C.q_upsert(spark, SF_SMALL))
    assert "Window" not in p
    assert "SortAggregate" in p or "ObjectHashAggregate" in p or "HashAggregate" in p


@pytest.mark.parametrize("name", ["flagship_stats", "parse_records", "explode_documents", "patch"])
def test_no_python_udfs_in_plans(spark, name):
    p = plan(C.QUERIES[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
