"""Exact places of rows in a global order, whatever the ties."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import stage

#: A row's number within its partition is held in these low bits of its numbering.
_ROW_BITS = 33


def places(rows: DataFrame, by: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2, ... in ascending order of ``by`` (nulls first).

    Rows are range-partitioned and sorted, numbered within their partition and
    moved by the sizes of the partitions before. A written number breaks ties, so
    equal rows are spread over partitions as any others, and a lost task finds
    the same order again.
    """
    numbered = stage(rows.withColumn("__n", F.monotonically_increasing_id()), "places-rows")
    dealt = numbered.repartitionByRange(*by, "__n").sortWithinPartitions(*by, "__n").drop("__n")
    dealt = stage(dealt.withColumn("__m", F.monotonically_increasing_id()), "places-order")
    part = F.shiftright("__m", _ROW_BITS)
    dealt = dealt.withColumn("__part", part)
    # one row per partition of a shuffle
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__rows"))
    offsets = counts.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    within = F.col("__m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    placed = dealt.join(F.broadcast(offsets), "__part")
    return placed.withColumn(name, F.col("__offset") + within).drop("__part", "__offset", "__m")
