"""A search by the trigram index gives the rows of a search of the whole table, and reads the buckets that may match."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordtable.operators.read import find
from recordtable.sources.layout import in_buckets, overwrite_buckets, with_bucket, write_bucketed
from recordtable.sources.tables import read_stored
from recordtable.sources.text_index import find_indexed, index_path, index_text, pattern_grams, stale_buckets

NAMES = [None, "", "a", "ab", "abc", "abcabc", "ABC", "xabcx", "ab%c", "a_bc", "back\\slash", "ΟΔΟΣ", "ΟΔΟΣΑ", "οδος", "日本語の", "aaaaaa", "İstanbul", "hot ring"]
PATTERNS = [
    ("abc", "like"), ("ab%c", "like"), ("ab%c", "literal"), ("a_c", "like"), ("bca", "like"), ("", "like"), ("ab", "like"), ("zzz", "like"), ("aaaa", "like"),
    ("ΟΔΟΣ", "like"), ("日本語", "literal"), ("k\\sl", "like"), ("cab%abc", "like"), ("abc%ring", "like"), ("ot r%n", "like"),
]


def _table(spark, path, buckets=8, copies=3):
    listed = [(i, n) for i, n in enumerate(NAMES * copies)]
    df = with_bucket(spark.createDataFrame(listed, "k long, name string"), "k", buckets)
    write_bucketed(df, path, "k", buckets)


def _same(spark, path, ignore_case=False):
    whole = read_stored(spark, path).drop("_bucket")
    for text, mode in PATTERNS:
        want = rows(find(whole, "name", text, mode, ignore_case, key="k", order=False))
        assert rows(find_indexed(spark, path, "k", "name", text, mode, ignore_case, order=False)) == want, (text, mode)


@pytest.mark.parametrize("ignore_case", [False, True])
def test_same_rows_with_a_new_an_old_and_a_renewed_index(spark, tmp_path, ignore_case):
    path = str(tmp_path / "t")
    _table(spark, path)
    assert index_text(spark, path, "k", "name", ignore_case) is None and stale_buckets(spark, path, "name", ignore_case) == []
    assert index_text(spark, path, "k", "name", ignore_case) == []
    _same(spark, path, ignore_case)
    # one bucket is rewritten: a row changes, a row goes
    bucket = with_bucket(spark.createDataFrame([(5,)], "k long"), "k", 8).first()["_bucket"]
    changed = in_buckets(read_stored(spark, path), [bucket], 8).withColumn("name", F.when(F.col("k") == 5, F.lit("xx abc hot ring")).otherwise(F.col("name")))
    overwrite_buckets(spark, changed.select("k", "name", "_bucket"), path, "k", 8, [bucket])
    assert stale_buckets(spark, path, "name", ignore_case) == [bucket]
    _same(spark, path, ignore_case)
    assert index_text(spark, path, "k", "name", ignore_case) == [bucket]
    _same(spark, path, ignore_case)
    # a bucket is emptied
    overwrite_buckets(spark, changed.limit(0).select("k", "name", "_bucket"), path, "k", 8, [bucket])
    assert stale_buckets(spark, path, "name", ignore_case) == [bucket]
    assert index_text(spark, path, "k", "name", ignore_case) == [bucket] and stale_buckets(spark, path, "name", ignore_case) == []


def test_only_candidate_buckets_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(4000).select(F.col("id").alias("k"), F.concat(F.lit("common name "), F.md5(F.col("id").cast("string"))).alias("name"))
    write_bucketed(with_bucket(df, "k", 32), path, "k", 32)
    index_text(spark, path, "k", "name")
    rare = df.where("k = 1234").first()["name"][-12:]
    found = find_indexed(spark, path, "k", "name", "mon name %" + rare, order=False)
    assert [r.k for r in found.collect()] == [1234]
    bucket = with_bucket(df.where("k = 1234"), "k", 32).first()["_bucket"]
    assert re.search(rf"PartitionFilters: \[[^\]]*_bucket#\d+ = {bucket}\)", found._jdf.queryExecution().executedPlan().toString())
    assert find_indexed(spark, path, "k", "name", "common name").count() == 4000  # every row is a candidate
    plan = read_stored(spark, index_path(path, "name", False)).where("gram = 'omm'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(gram,omm)" in plan


def test_grams():
    assert pattern_grams("abcd%ab_cde") == ["abc", "bcd", "cde"]
    assert pattern_grams("ab%cd") == [] and pattern_grams("AB%", "literal") == ["AB%"]
    assert pattern_grams("ABC", ignore_case=True) == ["abc"]


def test_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bucketed(with_bucket(spark.createDataFrame([(None, "abc")], "k long, name string"), "k", 4), path, None, 4)
    with pytest.raises(Exception, match="without k"):
        index_text(spark, path, "k", "name")
    with pytest.raises(ValueError, match="no bucketed table"):
        index_text(spark, str(tmp_path / "none"), "k", "name")
