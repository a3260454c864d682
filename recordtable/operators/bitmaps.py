"""Sets of integer keys as bitmaps: existence checks for key sets that are too many rows to broadcast.

A bitmap of Spark's ``bitmap_construct_agg`` holds 32,768 neighbouring keys in
4 KB, so 20 million keys of a dense range are some 600 rows and 2.5 MB. The
big side is filtered by a broadcast join on the bitmap's number and never
shuffled. Answers are exact. Whether the bitmaps are few enough is counted
first: keys scattered over a wide range need one each and keep the shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from recordtable.sources.sinks import stage

#: Bitmaps that may be broadcast: 16,384 of 4 KB are 64 MB.
MAX_BITMAPS = 16_384
#: Keys per bitmap and 64-bit words per bitmap, fixed by ``bitmap_bit_position``.
_WORDS = 32_768 // 64

_NUMBER, _BITS = "__rt_bm", "__rt_bits"


def is_integer_key(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (ByteType, ShortType, IntegerType, LongType))


def _number(key: str) -> Column:
    return F.bitmap_bucket_number(F.col(key).cast("long"))


def key_bitmaps(keys: DataFrame, key: str, max_bitmaps: int = MAX_BITMAPS) -> DataFrame | None:
    """The non-null ``keys[key]`` as at most ``max_bitmaps`` staged rows, or None if they need more (or are no integers).

    Two passes over ``keys`` with partial aggregates: one counts the bitmaps,
    one builds them; a task holds at most ``max_bitmaps`` of them.
    """
    if not is_integer_key(keys, key):
        return None
    ks = keys.select(key).where(F.col(key).isNotNull())
    if ks.select(_number(key).alias(_NUMBER)).distinct().count() > max_bitmaps:
        return None
    return _build(ks, key)


def _build(ks: DataFrame, key: str) -> DataFrame:
    position = F.bitmap_bit_position(F.col(key).cast("long"))
    maps = ks.groupBy(_number(key).alias(_NUMBER)).agg(F.bitmap_construct_agg(position).alias("bytes"))
    # as 64-bit words a key is tested without cutting the bytes for every row
    word = "cast(conv(hex(substring(bytes, 8 * i + 1, 8)), 16, -10) as bigint)"
    bits = F.expr(f"transform(sequence(0, {_WORDS - 1}), i -> {word})").alias(_BITS)
    return stage(maps.select(_NUMBER, bits), "key-bitmaps")


def where_in_bitmaps(df: DataFrame, key: str, bitmaps: DataFrame, present: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is (``present``) or is not in the set; a NULL key is in no set."""
    position = F.bitmap_bit_position(F.col(key).cast("long"))
    # bytes stand first to last in a word, bits of a byte last to first: the byte's place is turned round
    bit = position.bitwiseXOR(F.lit(56)).bitwiseAND(F.lit(63)).cast("int")
    word = F.get(F.col(_BITS), F.shiftright(position, 6).cast("int"))
    hit = F.coalesce(F.getbit(word, bit) == 1, F.lit(False))
    number = _number(key).alias(_NUMBER)
    joined = df.select("*", number).join(F.broadcast(bitmaps), _NUMBER, "inner" if present else "left")
    return joined.where(hit if present else ~hit).select(*[F.col(f"`{c}`") for c in df.columns])


def present_bitmaps(df: DataFrame, key: str, bitmaps: DataFrame) -> DataFrame:
    """The keys of the set that ``df`` holds, again as bitmaps: at most as many as ``bitmaps`` has."""
    return _build(where_in_bitmaps(df.select(key), key, bitmaps), key)
