"""Pages behind a cursor are the stretches of the full sort, read from few files."""

import pytest
from pyspark.sql import functions as F

from recordtable.operators.read import list_rows
from recordtable.plans.commands import RecordStore
from recordtable.fields import Contract, Field
from recordtable.sources.clustered import cluster_table, page, write_fences
from recordtable.sources.tables import publish, read_stored

NAMES = ["b", None, "a", "", "B", "é", "hot"]


def _rows(spark, n):
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.element_at(F.array(*[F.lit(x) for x in NAMES]), (F.col("id") % 7 + 1).cast("int")))
    return spark.range(n).select((F.col("id") * 7 % n).alias("k"), name.alias("name"), (F.col("id") % 5).alias("v"))


def _walk(spark, path, n):
    got, after = [], None
    while True:
        rows = [tuple(r) for r in page(spark, path, ["name", "k"], ["name"], "k", n, after).collect()]
        got += rows
        if len(rows) < n:
            return got
        after = rows[-1]


@pytest.mark.parametrize("size", [1, 37, 100, 1000])
def test_pages_are_the_full_sort(spark, tmp_path, size):
    path, total = str(tmp_path / "t"), 100 if size > 1 else 20
    df = _rows(spark, total)
    cluster_table(spark, df, path, ["name"], "k")
    want = [tuple(r) for r in list_rows(df, ["name", "k"], ["name"], total, key="k").collect()]
    assert _walk(spark, path, size) == want


def test_a_page_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cluster_table(spark, _rows(spark, 20_000), path, ["name"], "k")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = len(read_stored(spark, path).inputFiles())
    some = page(spark, path, ["name", "k"], ["name"], "k", 50, ("hot", 10_000))
    want = _rows(spark, 20_000).where("name = 'hot' and k > 10000").orderBy("k").limit(50)
    assert files >= 7 and len(some.inputFiles()) <= 2
    assert [r.k for r in some.collect()] == [r.k for r in want.collect()]
    assert page(spark, path, ["k"], ["name"], "k", 5, ("é", 10**6)).count() == 0
    assert page(spark, path, ["k"], ["name"], "k", 0).count() == 0


def test_a_rewritten_table_is_paged_without_its_fences(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _rows(spark, 60)
    cluster_table(spark, df, path, ["name"], "k")
    publish(spark, df.where("v <> 1").withColumn("k", F.col("k") + 1), path, "k")  # stays in the table's order
    want = [tuple(r) for r in list_rows(df.where("v <> 1").withColumn("k", F.col("k") + 1), ["name", "k"], ["name"], 60, key="k").collect()]
    assert _walk(spark, path, 11) == want
    write_fences(spark, path, ["name"], "k")
    assert _walk(spark, path, 11) == want
    cluster_table(spark, df.limit(0), path, ["name"], "k")
    assert _walk(spark, path, 11) == []


def test_cursor_and_size_are_checked(spark, tmp_path):
    path = str(tmp_path / "t")
    cluster_table(spark, _rows(spark, 10), path, ["name"], "k")
    for size in (-1, True, "3"):
        with pytest.raises(ValueError):
            page(spark, path, ["k"], ["name"], "k", size)
    with pytest.raises(ValueError):
        page(spark, path, ["k"], ["name"], "k", 3, ("a",))


def test_store_by_pages(spark, tmp_path):
    fields = (Field("k", "long", default=None), Field("name", "text"))
    store = RecordStore(spark, str(tmp_path / "s"), fields, Contract(key="k", not_null=("k",)), name_col="name", list_cols=("k", "name"), clustered=True)
    store.add(spark.range(50).select(F.col("id").alias("seq"), F.to_json(F.struct(F.col("id").alias("k"), F.lit("n").alias("name"))).alias("json")))
    store.delete(spark.range(10).select(F.col("id").alias("k")))
    assert [r.k for r in store.page(5).collect()] == [10, 11, 12, 13, 14]
    assert [r.k for r in store.page(5, ("n", 14)).collect()] == [15, 16, 17, 18, 19]
