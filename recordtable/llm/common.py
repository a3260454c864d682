"""Helpers shared by the training-data operators: stages, bounded membership filters, row removal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.session import ensure_checkpoint_dir, shared_path

#: log2 of the 64-bit words in a membership filter: at most 2**17 rows of (int, long) are broadcast.
FILTER_WORD_BITS = 17


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    The written table cuts the lineage: a lost executor is recovered by reading
    it again. It is left in the checkpoint folder, as lazy results read it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_membership(df: DataFrame, hashed: Column, members: DataFrame, member_hash: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: false only if ``hashed`` is surely not among ``members[member_hash]``.

    ``members`` is folded into a fixed-size bitmap of ``2**FILTER_WORD_BITS``
    64-bit words, so the broadcast side is bounded whatever the size of
    ``members``; a full bitmap only lets more rows through to the exact step
    that must follow. No row is lost and none is repeated.
    """
    shift, word, bit = 64 - FILTER_WORD_BITS, "__mw", "__mb"
    words = (
        members.select(F.col(member_hash).alias("__h"))
        .where(F.col("__h").isNotNull())
        .groupBy(F.shiftrightunsigned("__h", shift).cast("int").alias(word))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__h & 63 as int))")).alias(bit))
    )
    out = df.withColumn("__h", hashed).withColumn(word, F.shiftrightunsigned("__h", shift).cast("int"))
    out = out.join(F.broadcast(words), word, "left")
    hit = F.expr(f"{bit} is not null and getbit({bit}, cast(__h & 63 as int)) = 1")
    return out.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(word, bit, "__h")


def join_hot(many: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` where ``few`` is an aggregate by it and ``many`` may hold a hot key.

    The hash beside the key makes Spark exchange both sides anew for the join;
    only then can AQE split a hot key's rows.
    """
    few = few.withColumn("__j", F.xxhash64(key))
    return many.withColumn("__j", F.xxhash64(key)).join(few, ["__j", key], how).drop("__j")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` and its lambdas use it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def row_key(df: DataFrame, id_col: str, text_col: str) -> Column:
    """Hash that identifies a document row by its id and whole text (null text counts as empty)."""
    return F.xxhash64(df[id_col], F.coalesce(df[text_col], F.lit("")))


def remove_rows(docs: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows named by ``removed(__key, __keep)``; all columns stay.

    ``__key`` is :func:`row_key`; of the rows with a named key ``__keep``
    (0 or 1) stay. Only rows that may be named are shuffled: the others pass
    a bounded membership filter and go straight to the output, so texts of
    kept documents are not moved. Where one row of a key stays it is the least by
    the hash of all its columns, found by an aggregate that keeps one row per
    task, so a row repeated any number of times is not gathered.
    """
    keyed = docs.withColumn("__key", row_key(docs, id_col, text_col))
    flagged = with_membership(keyed, F.col("__key"), removed, "__key", "__maybe")
    clear = flagged.where(~F.col("__maybe")).select(*docs.columns)
    maybe = join_hot(flagged.where("__maybe"), removed.select("__key", "__keep"), "__key", "left")
    unnamed = maybe.where("__keep is null").select(*docs.columns)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    hashable = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    one = maybe.where("__keep = 1").groupBy("__key").agg(F.min_by(whole, F.xxhash64(*hashable)).alias("__row"))
    return clear.unionByName(unnamed).unionByName(one.select("__row.*"))
