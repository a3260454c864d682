"""Hilbert sharding: the curve, the law, and what a reader can skip."""

import itertools
import zlib

import pytest
from cases import SF_ORACLE, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from recordtable.llm import sharding as S


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (2, 1), (4, 2), (1, 5)])
def test_curve_visits_every_cell_in_unit_steps(spark, axes, bits):
    cells = list(itertools.product(range(1 << bits), repeat=axes))
    names = [f"c{i}" for i in range(axes)]
    df = spark.createDataFrame(cells, names).withColumn("h", S.hilbert_index([F.col(n) for n in names], bits))
    rows = sorted(map(tuple, df.collect()), key=lambda r: r[-1])
    assert [r[-1] for r in rows] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(p[:-1], q[:-1], strict=True)) == 1 for p, q in itertools.pairwise(rows))


def test_cells(spark):
    sizes = [None, 0, 1, 2, 3, 4, 6, 1000, 2**40]
    df = spark.createDataFrame([(n,) for n in sizes], "n long")
    got = [r[0] for r in df.select(S.magnitude(F.col("n"))).collect()]
    assert got == [0, 0, 0, 2, 3, 4, 5, 19, 63] and got[1:] == sorted(got[1:])
    words = spark.createDataFrame([(None,), ("en",)], "s string")
    assert [r[0] for r in words.select(S.category(F.col("s"))).collect()] == [0, zlib.crc32(b"en") % 64]


def check(docs, rows, shards):
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in docs)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    counts = [0] * shards
    for r in sorted(rows, key=lambda r: (r.shard, r.slot)):
        assert r.slot == counts[r.shard]
        counts[r.shard] += 1
    assert max(counts) - min(counts) <= 1
    order = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_law(spark, awkward, shards):
    check([r.text for r in awkward.collect()], S.shard(awkward, shards).collect(), shards)


def test_table_and_empty(spark, nothing):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    check([r.text for r in docs.select("text").collect()], S.shard(docs).collect(), 40)
    assert S.shard(nothing).count() == 0


def test_files_are_narrow_in_every_dimension(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    sharded = S.shard(docs, 40)
    S.write_shards(docs, sharded, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    per = back.groupBy("shard").agg(F.count_distinct("lang").alias("langs"), F.max(F.length("text")).alias("longest")).collect()
    assert len(per) == 40
    assert sum(r.langs for r in per) < 0.6 * 4 * 40  # by chance nearly every shard would have all four


def test_no_python_in_the_plan(spark, awkward, capsys):
    S.shard(awkward).explain()
    assert "Python" not in capsys.readouterr().out
