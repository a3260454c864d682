"""Key sets as bitmaps give the rows of the shuffle joins, without shuffling the table."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordtable.operators.bitmaps import key_bitmaps, where_in_bitmaps
from recordtable.operators.change import delete
from recordtable.operators.read import lookup

EDGES = [0, 1, -1, 2, 7, 8, 63, 64, 65, 32767, 32768, 32769, -32767, -32768, -32769, 2**31, 2**40, 2**63 - 1, -(2**63) + 1, -(2**63)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("drop", range(0, len(EDGES), 3))
def test_every_bit_is_where_it_was_put(spark, drop):
    keys = [k for i, k in enumerate(EDGES) if i % 3 != drop % 3]
    maps = key_bitmaps(spark.createDataFrame([(k,) for k in keys] + [(None,), (keys[0],)], "k long"), "k")
    table = spark.createDataFrame([(k,) for k in EDGES] + [(None,), (3,), (66,)], "k long")
    assert {r[0] for r in rows(where_in_bitmaps(table, "k", maps))} == set(keys)
    absent = where_in_bitmaps(table, "k", maps, present=False).collect()
    assert {r[0] for r in absent} == (set(EDGES) | {3, 66, None}) - set(keys)


@pytest.mark.parametrize("kind", ["int", "long", "smallint"])
def test_delete_and_lookup_equal_the_shuffle_join(spark, kind):
    table = spark.range(-300, 20_000).select(F.col("id").cast(kind).alias("k"), F.expr("id * 2").alias("v"))
    table = table.union(table.where("v % 7 = 0")).unionByName(spark.createDataFrame([(None, 5)], f"k {kind}, v long"))
    keys = spark.range(-5000, 30_000, 3).select(F.col("id").cast(kind).alias("q"))
    keys = keys.union(keys.where("q % 5 = 0")).unionByName(spark.createDataFrame([(None,)], f"q {kind}"))
    by_bits = delete(table, keys, "k", "q", max_broadcast_rows=10)
    by_join = delete(table, keys, "k", "q", max_broadcast_rows=10, max_bitmaps=0)
    for got, want in zip(by_bits, by_join):
        assert got.columns == want.columns and rows(got) == rows(want)
    assert "SortMergeJoin" in _plan(by_join[0])
    assert "BroadcastHashJoin" in _plan(by_bits[0]) and "hashpartitioning" not in _plan(by_bits[0])
    found = lookup(table, "k", keys=keys, keys_key="q", max_broadcast_rows=10)
    assert rows(found) == rows(lookup(table, "k", keys=keys, keys_key="q"))


def test_twenty_million_keys_are_a_few_bitmaps(spark):
    keys = spark.range(0, 20_000_000)
    maps = key_bitmaps(keys, "id")
    assert maps.count() <= 612
    table = spark.range(-1000, 40_000_000, 1000)
    assert where_in_bitmaps(table, "id", maps).count() == 20_000


def test_scattered_and_other_keys_keep_the_shuffle_join(spark):
    scattered = spark.range(0, 100).select((F.col("id") * 10**6).alias("k"))
    assert key_bitmaps(scattered, "k", max_bitmaps=50) is None
    assert key_bitmaps(scattered.select(F.col("k").cast("string").alias("k")), "k") is None
    text = scattered.select(F.col("k").cast("string").alias("k"))
    result, missing = delete(text, text.limit(40), "k", max_broadcast_rows=1)
    assert result.count() == 60 and missing.count() == 0


def test_empty_sides(spark):
    none, some = spark.range(0), spark.range(5)
    maps = key_bitmaps(none, "id")
    assert where_in_bitmaps(some, "id", maps).count() == 0
    assert where_in_bitmaps(some, "id", maps, present=False).count() == 5
    assert where_in_bitmaps(none, "id", key_bitmaps(some, "id"), present=False).count() == 0
