"""Sharding along a Hilbert curve: rows that are alike in several metadata dimensions share a shard.

Each dimension is quantised to ``BITS`` bits (categories by hash, sizes by a
logarithmic scale), the cell's index along the Hilbert curve orders the rows,
and the order is cut into runs of equal row counts. A run covers few cells,
which lie together in every dimension, so the files of a shard have narrow
value ranges and readers skip most shards for a filter on any dimension.

Global places without a global sort in one task: rows (id, curve index, size,
digest; no text) are range-partitioned by (index, digest, id) and written with
their partition's number, so the places are read from data that does not
change; each partition numbers its own rows, and the partitions' row counts
(one number each) give the offsets. A hot cell is split by digest and id.

Defined results: the law is ``rows``: counts of shards differ by one at most;
null texts have 0 bytes, null dimensions are a category of their own; equal
rows are put side by side; an empty table gives no rows; with fewer rows than
shards some shards are empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import let, stage

SHARDS = 40
BITS = 6
ROW_BYTES = 16
#: A table of at most 2**18 cells is broadcast, a larger one is joined by a shuffle.
BROADCAST_BITS = 18


def category(value: Column, bits: int = BITS) -> Column:
    """A category's cell: hash of its text; null is cell 0."""
    return F.coalesce(F.crc32(value.cast("string").cast("binary")) % (1 << bits), F.lit(0)).cast("int")


def magnitude(value: Column, bits: int = BITS) -> Column:
    """A size's cell: two cells per power of two; the last cell takes what is beyond."""
    n = F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)).cast("long")
    digits = F.length(F.bin(n))
    half = F.when(digits >= 2, F.substring(F.bin(n), 2, 1).cast("int")).otherwise(0)
    return F.least(2 * (digits - 1) + half, F.lit((1 << bits) - 1)).cast("int")


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place along the Hilbert curve of a cell given by ``len(cells)`` coordinates of ``bits`` bits each.

    Bit planes are worked from the highest down (J. Skilling, 2004): a plane's
    turn of the curve is undone for all lower bits, then the planes are Gray
    coded and interleaved.
    """
    n = len(cells)
    if n * bits > 62:
        raise ValueError("at most 62 bits in all")
    axes = F.sequence(F.lit(0), F.lit(n - 1))
    planes = F.sequence(F.lit(bits - 1), F.lit(1), F.lit(-1)) if bits > 1 else F.expr("cast(array() as array<int>)")

    def bit(plane: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), plane)

    def turned(x: Column, q: Column) -> Column:
        low = q - 1

        def one(x: Column, i: Column) -> Column:
            def swapped(swap: Column) -> Column:
                return F.transform(
                    x, lambda v, j: v.bitwiseXOR(F.when(j == 0, swap).otherwise(0)).bitwiseXOR(F.when(j == i, swap).otherwise(0))
                )

            here = F.get(x, i)
            flipped = F.transform(x, lambda v, j: F.when(j == 0, v.bitwiseXOR(low)).otherwise(v))
            swap = F.get(x, F.lit(0)).bitwiseXOR(here).bitwiseAND(low)
            return F.when(here.bitwiseAND(q) != 0, flipped).otherwise(let(swap, swapped))

        return F.aggregate(axes, x, one)

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, i: F.aggregate(F.slice(x, F.lit(1), i + 1), F.lit(0), lambda a, w: a.bitwiseXOR(w)))

    def tail(x: Column) -> Column:
        last = F.get(x, F.lit(n - 1))
        return F.aggregate(
            planes, F.lit(0), lambda t, p: F.when(last.bitwiseAND(bit(p)) != 0, t.bitwiseXOR(bit(p) - 1)).otherwise(t)
        )

    def interleaved(x: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)),
            F.lit(0).cast("long"),
            lambda h, p: F.aggregate(x, h, lambda h, v: h * 2 + F.call_function("getbit", v, p).cast("long")),
        )

    x = F.aggregate(planes, F.array(*[c.cast("int") for c in cells]), lambda x, p: let(bit(p), lambda q: turned(x, q)))
    # Gray code: each axis by those before it, then all by the last one's higher planes
    untwisted = let(let(x, gray), lambda x: let(tail(x), lambda t: F.transform(x, lambda v: v.bitwiseXOR(t))))
    return let(untwisted, interleaved)


def hilbert_order(rows: DataFrame, index: str, ties: list[str]) -> DataFrame:
    """``rows`` with ``place``: 0, 1, 2, ... in the order of ``index`` and ``ties``."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, index, *ties).withColumn("__part", F.spark_partition_id())
    dealt = stage(dealt, "shard-order")
    counts = dealt.groupBy("__part").agg(F.count("*").alias("n"))
    # one row per partition, a bounded number
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"), F.sum("n").over(Window.partitionBy()).alias("total"))
    within = F.row_number().over(Window.partitionBy("__part").orderBy(index, *ties))
    placed = dealt.withColumn("__n", within).join(F.broadcast(offsets), "__part")
    return placed.withColumn("place", F.col("__offset") + F.col("__n") - 1).drop("__part", "__n", "__offset")


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    categories: tuple[str, ...] = ("lang", "source"),
    bits: int = BITS,
) -> DataFrame:
    """One row per input row: ``<id_col>, size, text_crc32, curve, shard, slot``.

    Dimensions: the ``categories`` columns and the text's size in bytes;
    ``slot`` counts from 0 within a shard along the curve.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    cells = [category(F.col(c), bits) for c in categories] + [magnitude(F.octet_length(text), bits)]
    rows = docs.select(
        F.col(id_col).alias("__id"),
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.array(*cells).alias("cell"),
    )
    # texts are read once; the curve's index is worked out once for each cell in use
    rows = stage(rows, "shard-rows")
    axes = [F.get("cell", F.lit(i)) for i in range(len(cells))]
    curve = rows.select("cell").distinct().withColumn("curve", hilbert_index(axes, bits))
    small = len(cells) * bits <= BROADCAST_BITS  # so many cells at most, whatever the data
    rows = rows.join(F.broadcast(curve) if small else curve, "cell").drop("cell")
    placed = hilbert_order(rows, "curve", ["text_crc32", "size", "__id"])
    # exact in whole numbers: shard s holds the places p with s * total <= p * shards < (s + 1) * total
    number = F.expr(f"place * {shards} div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", number.cast("int"))
    return placed.select(F.col("__id").alias(id_col), "size", "text_crc32", "curve", "shard", (F.col("place") - first).alias("slot"))


def write_shards(rows: DataFrame, sharded: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``rows`` (unique ids, no column ``shard``) as one folder per shard, along the curve.

    A task writes a run of the order, so a shard of any size is several files of bounded size.
    """
    placed = rows.join(sharded.select(id_col, "shard", F.col("slot").alias("__slot")), id_col)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartitionByRange(parts, "shard", "__slot").sortWithinPartitions("shard", "__slot")
    dealt.drop("__slot").write.partitionBy("shard").parquet(path)
