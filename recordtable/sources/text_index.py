"""Trigram index of a text column of a bucketed table: substring search that scans only the buckets that may match.

The index is a stored table of its own beside the table, with the same
buckets: one row ``(gram, key)`` for every different run of three characters of a
row's text, sorted by gram inside a bucket's file, so a search reads the row groups of its
grams only. A common gram is many rows, never one long list.

A bucket's index also names the files it was made from (rows with an empty
gram). A bucket whose files are no longer those, whoever wrote them, is
searched in full until ``index_text`` is called again, which redoes such buckets
alone. So a search is exact at any time, and an index may lag behind.

What the index gives are candidates: rows that hold the rarest grams of the
pattern's literal parts. ``read.find`` then decides on them, so results are
those of ``find`` on the whole table. A pattern without a literal part of three
characters scans the table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.operators.read import find, lookup
from recordtable.sources.sinks import stage
from recordtable.sources.tables import BUCKET_COL, exists, publish, read_stored, stored_buckets

GRAM = 3
#: At most this many grams of a pattern are looked up, the rarest ones ...
MAX_GRAMS = 4
#: ... and none that has more than this many times the rows of the rarest.
MAX_SPREAD = 8


def index_path(path: str, col: str, ignore_case: bool) -> str:
    return f"{path.rstrip('/')}-grams-{col}{'-lower' if ignore_case else ''}"


def pattern_grams(text: str, mode: str = "like", ignore_case: bool = False) -> list[str]:
    """Different trigrams of the literal parts of a ``find`` pattern, in order; all of them are in every match."""
    t = text.lower() if ignore_case else text
    parts = re.split("[%_]", t) if mode == "like" else [t]
    return list(dict.fromkeys(p[i : i + GRAM] for p in parts for i in range(len(p) - GRAM + 1)))


def _buckets(spark: SparkSession, path: str) -> int:
    buckets = stored_buckets(spark, path) if exists(spark, path) else None
    if not isinstance(buckets, int):
        raise ValueError(f"no bucketed table in the catalog at {path}")
    return buckets


def _files(table: DataFrame) -> dict[int, set[str]]:
    """File names of each bucket, from the listing that the scan of the table is planned with."""
    found: dict[int, set[str]] = {}
    for name in table.inputFiles():
        bucket = re.search(rf"/{BUCKET_COL}=(\d+)/([^/]+)$", name)
        if bucket:
            found.setdefault(int(bucket[1]), set()).add(bucket[2])
    return found


def _indexed_files(index: DataFrame) -> dict[int, set[str]]:
    found: dict[int, set[str]] = {}
    for row in index.where("gram = ''").select(BUCKET_COL, "source").collect():  # one row per file of the table
        found.setdefault(row[0], set()).add(row[1])
    return found


def _postings(table: DataFrame, key: str, col: str, ignore_case: bool) -> DataFrame:
    text = F.lower(F.col(col)) if ignore_case else F.col(col)
    rows = table.select(F.col(key).alias("key"), text.alias("text"), BUCKET_COL)
    rows = rows.withColumn("key", F.when(F.col("key").isNull(), F.raise_error(F.lit(f"a row without {key} cannot be indexed"))).otherwise(F.col("key")))
    starts = F.sequence(F.lit(1), F.length("text") - (GRAM - 1))
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("text"), i, F.lit(GRAM))))
    grams = rows.where(F.length("text") >= GRAM).select(F.explode(cut).alias("gram"), "key", F.lit(None).cast("string").alias("source"), BUCKET_COL)
    files = table.select(F.col("_metadata.file_name").alias("source"), BUCKET_COL).distinct()
    marks = files.select(F.lit("").alias("gram"), F.lit(None).cast(table.schema[key].dataType).alias("key"), "source", BUCKET_COL)
    return grams.unionByName(marks)


def stale_buckets(spark: SparkSession, path: str, col: str, ignore_case: bool = False) -> list[int]:
    """Buckets whose files are not those that the index was made from (also buckets that only the index has)."""
    now, then = _files(read_stored(spark, path)), _indexed_files(read_stored(spark, index_path(path, col, ignore_case)))
    return sorted(b for b in now.keys() | then.keys() if now.get(b) != then.get(b))


def index_text(spark: SparkSession, path: str, key: str, col: str, ignore_case: bool = False) -> list[int] | None:
    """Make or bring up to date the index on ``col``; returns the buckets that were redone (None: all).

    With ``ignore_case`` it serves searches that ignore case, else the others.
    ``key`` must not be null. One pass over the column, one exchange by bucket.
    """
    buckets, where = _buckets(spark, path), index_path(path, col, ignore_case)
    table = read_stored(spark, path)
    redo = stale_buckets(spark, path, col, ignore_case) if exists(spark, where) else None
    if redo == []:
        return redo
    scope = table if redo is None else table.where(F.col(BUCKET_COL).isin(redo))
    publish(spark, _postings(scope, key, col, ignore_case), where, "gram", buckets, redo, sort=["gram", "key"])
    return redo


def candidates(index: DataFrame, grams: Sequence[str]) -> DataFrame | None:
    """Staged ``(key, _bucket)`` of the rows that hold the rarest of ``grams``; None if some gram is nowhere."""
    hits = index.where(F.col("gram").isin(list(grams)))
    counts = {r["gram"]: r["n"] for r in hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per gram
    if len(counts) < len(grams):
        return None
    ranked = sorted(counts, key=lambda g: (counts[g], g))[:MAX_GRAMS]
    used = [g for g in ranked if counts[g] <= MAX_SPREAD * counts[ranked[0]]]
    both = index.where(F.col("gram").isin(used)).groupBy("key", BUCKET_COL).agg(F.count(F.lit(1)).alias("n"))
    return stage(both.where(F.col("n") >= len(used)).select("key", BUCKET_COL), "candidates")


def find_indexed(
    spark: SparkSession,
    path: str,
    key: str,
    col: str,
    text: str,
    mode: str = "like",
    ignore_case: bool = False,
    cols: Sequence[str] | None = None,
    order: bool = True,
) -> DataFrame:
    """``find`` on the stored table by its index: the same rows, read from the buckets that hold candidates."""
    table = read_stored(spark, path)
    grams = pattern_grams(text, mode, ignore_case)
    where = index_path(path, col, ignore_case)
    if grams and exists(spark, where):
        index = read_stored(spark, where)
        now, then = _files(table), _indexed_files(index)
        stale = [b for b in now if now[b] != then.get(b)]
        some = candidates(index, grams)
        held = [] if some is None else [r[0] for r in some.select(BUCKET_COL).distinct().collect()]  # at most ``buckets`` numbers
        held = sorted(b for b in held if b in now and b not in stale)
        found = table.where(F.col(BUCKET_COL).isin(stale)) if stale or not held else None
        if held:
            chosen = lookup(table.where(F.col(BUCKET_COL).isin(held)), key, keys=some, keys_key="key")
            found = chosen if found is None else chosen.unionByName(found)
        table = found
    return find(table.drop(BUCKET_COL), col, text, mode, ignore_case, cols=cols, key=key, order=order)
