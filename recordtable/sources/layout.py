"""Key-bucket layout: rewrite only the part of a table a change touches.

A table is stored as parquet partitioned by
``_bucket = pmod(xxhash64(cast(key as string)), n)``; hashing the text form
puts a key in the same bucket whether a batch carries it as int or bigint.
A change set names at most ``n`` buckets; the new table is computed for
those buckets only (the bucket filter prunes the scan to their
directories), staged, and put in place by Spark's dynamic partition overwrite. A small change to a
big table then reads and writes about ``touched / n`` of it instead of all
of it. Point lookups by key prune to one bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.sources.tables import BUCKET_COL, publish


def bucket_of(key: Column | str, n: int) -> Column:
    if n < 1:
        raise ValueError("bucket count must be >= 1")
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k.cast("string")), F.lit(n)).cast("int")


def with_bucket(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn(BUCKET_COL, bucket_of(key, n))


def touched_buckets(changes: DataFrame, key: str, n: int) -> list[int]:
    """Distinct buckets of the change keys.

    At most ``n`` small integers reach the driver, whatever the size of the
    change set (partial distinct per task, then one merge).
    """
    rows = changes.select(bucket_of(key, n).alias("b")).where(F.col(key).isNotNull()).distinct().collect()
    return sorted(r.b for r in rows)


def write_bucketed(df: DataFrame, path: str, key: str | None, buckets: int) -> None:
    """First write of a bucketed table (``df`` must carry ``_bucket``).

    Rows are hash-partitioned on the bucket first, so each bucket is written
    by one task: one file per bucket instead of one per task and bucket.
    Keys are unique, so buckets are even; choose their number so that a
    bucket fits a task.
    """
    publish(df.sparkSession, df, path, key, buckets)


def in_buckets(df: DataFrame, touched: Sequence[int], n: int) -> DataFrame:
    """Rows of the given buckets of ``n``: pruned by a filter, which is left out where it names more than half of them."""
    return df.where(F.col(BUCKET_COL).isin(list(touched))) if 2 * len(touched) <= n else df


def overwrite_buckets(spark: SparkSession, result: DataFrame, path: str, key: str | None, n: int, touched: Iterable[int]) -> str:
    """Replace the touched buckets of the table at ``path`` (of ``n`` buckets) with ``result``'s rows for them.

    ``result`` may read the table itself: it is staged first. Buckets
    left empty by the change are removed; the table's schema is kept, so it
    can be read when no bucket is left. All other buckets are not written.
    """
    touched = sorted(set(int(b) for b in touched))
    return publish(spark, result, path, key, n, touched)
