"""Group statistics that follow a table's changes without reading it again.

Kept per group: the number of rows and, for each averaged column, its sum and the
number of its non-null values. A change batch adds the parts of the rows it
touched as they are after it and takes away those of the same rows before it;
both are aggregates of changed rows only. Sums are kept as ``decimal(38, 12)``, so
that adding and taking away leave no rest (floating-point sums would drift).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_TYPE = "decimal(38,12)"


def stat_parts(df: DataFrame, key: str, avgs: Mapping[str, str] | list[str], sign: int = 1) -> DataFrame:
    """``<key>, rows, sum_<col>..., n_<col>...`` per group (null is a group); partial aggregates per task."""
    out: list[Column] = [(F.lit(sign) * F.count(F.lit(1))).alias("rows")]
    for c in avgs:
        out.append((F.lit(sign) * F.coalesce(F.sum(F.col(c).cast(SUM_TYPE)), F.lit(0))).cast(SUM_TYPE).alias(f"sum_{c}"))
        out.append((F.lit(sign) * F.count(c)).alias(f"n_{c}"))
    return df.groupBy(key).agg(*out)


def stat_delta(before: DataFrame, after: DataFrame, key: str, avgs: Mapping[str, str] | list[str]) -> DataFrame:
    """Signed parts of a change: the touched rows ``after`` it less the same rows ``before`` it."""
    return _summed(stat_parts(after, key, avgs).unionByName(stat_parts(before, key, avgs, -1)), key)


def _summed(parts: DataFrame, key: str) -> DataFrame:
    sums = [F.sum(c).cast(SUM_TYPE if c.startswith("sum_") else "long").alias(c) for c in parts.columns if c != key]
    return parts.groupBy(key).agg(*sums)


def merge_parts(parts: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """Parts after the change; groups without rows go. Batches may be merged in any order."""
    return _summed(parts.unionByName(delta), key).where(F.col("rows") != 0)


def stats_of_parts(parts: DataFrame, key: str, avgs: Mapping[str, str], count_name: str) -> DataFrame:
    """The columns and rows of :func:`recordtable.operators.read.group_stats`, from the parts."""
    means = [(F.col(f"sum_{c}").cast("double") / F.nullif(F.col(f"n_{c}"), F.lit(0))).alias(out) for c, out in avgs.items()]
    return parts.select(key, F.col("rows").alias(count_name), *means).orderBy(F.col(count_name).desc(), F.col(key).asc_nulls_first())
