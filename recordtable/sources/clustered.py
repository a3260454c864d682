"""Listing by pages: a table kept in the order of its listing, read from a cursor on.

``cluster_table`` writes a flat table range-partitioned and sorted by
``(columns of the order, key)``, nulls first: each file is one stretch of the
listing, and a hot name is cut at its keys. Beside it lie the *fences*,
a row per file: its first and last place and its number of rows.

``page`` returns the ``n`` rows behind a cursor, the place of the last row that was
seen. The fences name the few files that hold them; inside a file row groups
are pruned by the cursor's comparison. A page costs the same wherever it
lies, unlike ``OFFSET``, and no row is seen twice or left out when others
come or go between pages.

Fences know the names of their files. If the table was rewritten since, a page is taken from
the whole table: the same rows, by a top-n over a scan, until ``write_fences`` is called.

The order's columns are texts, integers, dates or times without commas in their names; keys are unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.sources.tables import exists, publish, read_stored

#: Fences looked at in the first round; each further round looks at four times as many.
FIRST_FENCES = 8


def fences_path(path: str) -> str:
    return f"{path.rstrip('/')}-fences"


def _beyond(cols: Sequence[Column], after: Sequence[Any]) -> Column:
    """``cols > after`` by the first column that differs, nulls first."""
    if len(cols) != len(after):
        raise ValueError(f"a cursor needs {len(cols)} values, got {len(after)}")
    options = []
    for i, (c, value) in enumerate(zip(cols, after)):
        more = c.isNotNull() if value is None else c > F.lit(value)
        same = [d.isNull() if v is None else d == F.lit(v) for d, v in zip(cols[:i], after[:i])]
        options.append(reduce(lambda a, b: a & b, [*same, more]))
    return reduce(lambda a, b: a | b, options)


def cluster_table(spark: SparkSession, df: DataFrame, path: str, order: Sequence[str], key: str) -> None:
    """Make ``df`` the table at ``path``, in the order of its listing, with its fences."""
    publish(spark, df, path, key, sort=[*order, key])
    write_fences(spark, path, order, key)


def write_fences(spark: SparkSession, path: str, order: Sequence[str], key: str) -> None:
    """One pass over the order's columns; partial aggregates, one row per file."""
    table = read_stored(spark, path)
    place = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([*order, key])])
    rows = table.select(F.col("_metadata.file_name").alias("file"), place.alias("place"))
    fences = rows.groupBy("file").agg(F.min("place").alias("first"), F.max("place").alias("last"), F.count(F.lit(1)).alias("n"))
    publish(spark, fences, fences_path(path), "file")


def _page_files(table: DataFrame, fences: DataFrame, by: Sequence[str], after: Sequence[Any] | None, n: int) -> list[str] | None:
    """Files that hold the ``n`` rows behind the cursor, or None if the fences are not of the table's files."""
    files = {name.rsplit("/", 1)[1]: name for name in table.inputFiles()}
    filled = {r["file"] for r in fences.select("file").collect()}  # as many as the listing of the table has
    if not filled <= files.keys() or (files.keys() - filled and _has_rows(table, [files[f] for f in files.keys() - filled])):
        return None
    first, last = ([F.col(f"{edge}.k{i}") for i in range(len(by))] for edge in ("first", "last"))
    ahead = fences if after is None else fences.where(_beyond(last, after))
    full = F.lit(True) if after is None else _beyond(first, after)
    ahead = ahead.select("file", "n", full.alias("full"), "first").orderBy(*[c.asc_nulls_first() for c in first])
    look = FIRST_FENCES
    while True:
        some = ahead.limit(look).collect()
        chosen, rows = [], 0
        for fence in some:
            if rows >= n:
                break
            chosen.append(files[fence["file"]])
            rows += fence["n"] if fence["full"] else 0
        if rows >= n or len(some) < look:
            return chosen
        look *= 4


def _has_rows(table: DataFrame, files: list[str]) -> bool:
    """Whether files without a fence hold rows (a writer may leave an empty one)."""
    return not table.sparkSession.read.schema(table.schema).parquet(*files).isEmpty()


def page(
    spark: SparkSession,
    path: str,
    cols: Sequence[str],
    order: Sequence[str],
    key: str,
    n: int,
    after: Sequence[Any] | None = None,
) -> DataFrame:
    """The first ``n`` rows behind ``after`` (``order``'s values and the key's; None: from the start), in order."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 0:
        raise ValueError(f"page size must be an integer >= 0, got {n!r}")
    table, by = read_stored(spark, path), [*order, key]
    rows = table
    if exists(spark, fences_path(path)):
        files = _page_files(table, read_stored(spark, fences_path(path)), by, after, n)
        if files is not None:
            rows = spark.read.schema(table.schema).parquet(*files) if files else table.limit(0)
    if after is not None:
        rows = rows.where(_beyond([F.col(c) for c in by], after))
    return rows.orderBy(*[F.col(c).asc_nulls_first() for c in by]).limit(n).select(*cols)
