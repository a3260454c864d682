"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Three passes, each reading more of fewer documents:

1. count documents by text length (bytes);
2. hash a prefix of those whose length is shared, count by (length, prefix);
3. hash the full text only where length and prefix are shared.

Survivors of a pass are kept as a fixed-size bitmap (broadcast, bounded), so
no text is ever shuffled: only ids, counts and digests are. A false positive
of the bitmap only costs one more hash; the final grouping is on SHA-256.

Defined results: null text counts as empty; an empty table gives an empty
result; of equal texts the row with the largest id stays (null ids last); if
a row repeats (same id and text), exactly one of its copies stays. Extra
columns of the input are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, remove_rows, row_key, stage, with_membership

PREFIX_CHARS = 256


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per input row: ``<id_col>, keep_id, group_size, kept, digest, row_key``.

    ``digest`` (SHA-256, hex) is set where the full text was read, i.e. where
    length and prefix are shared; elsewhere the text is known to be unique.
    ``carry`` adds columns computed from the row's ``text`` in the last pass.
    """
    carry = carry or {}
    rows = docs.select(
        F.col(id_col).alias("__id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        row_key(docs, id_col, text_col).alias("__key"),
    ).withColumn("__len", F.octet_length("text"))

    lengths = rows.groupBy("__len").agg(F.count("*").alias("n")).where("n > 1").select(F.xxhash64("__len").alias("h"))
    lengths = stage(lengths, "dedup-lengths")
    by_length = with_membership(rows, F.xxhash64("__len"), lengths, "h", "__shared_len")
    prefixed = by_length.withColumn(
        "__ph", F.when(F.col("__shared_len"), F.xxhash64("__len", F.substring("text", 1, prefix_chars)))
    )

    prefixes = prefixed.where("__ph is not null").groupBy("__ph").agg(F.count("*").alias("n")).where("n > 1")
    prefixes = stage(prefixes.select("__ph"), "dedup-prefixes")
    hashed = with_membership(prefixed, F.col("__ph"), prefixes, "__ph", "__shared_prefix").select(
        "__id",
        "__key",
        F.when(F.col("__shared_prefix") & F.col("__ph").isNotNull(), F.sha2("text", 256)).alias("digest"),
        F.monotonically_increasing_id().alias("__no"),
        *[c.alias(name) for name, c in carry.items()],
    )
    hashed = stage(hashed, "dedup-digests")  # with the rows' numbers, which are settled by this

    candidates = hashed.where("digest is not null")
    # rows of one id are told apart by their numbers, so exactly one of them stays
    last = F.max(F.struct("__id", "__no"))
    groups = candidates.groupBy("digest").agg(last["__id"].alias("keep_id"), last["__no"].alias("__last"), F.count("*").alias("group_size"))
    many = join_hot(candidates, groups, "digest")
    kept = F.col("__no") == F.col("__last")
    columns = ["keep_id", "group_size", "kept", "digest", F.col("__key").alias("row_key"), *carry]
    many = many.withColumn("kept", kept).select(F.col("__id").alias(id_col), *columns)
    alone = (
        hashed.where("digest is null")
        .withColumn("keep_id", F.col("__id"))
        .withColumn("group_size", F.lit(1).cast("long"))
        .withColumn("kept", F.lit(True))
        .select(F.col("__id").alias(id_col), *columns)
    )
    return many.unionByName(alone)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    decided = exact_dedup(docs, id_col, text_col, **options)
    removed = (
        decided.where("group_size > 1")
        .groupBy(F.col("row_key").alias("__key"))
        .agg(F.max(F.col("kept").cast("int")).alias("__keep"), F.count("*").alias("__n"))
        .where("__keep < __n")
        .select("__key", "__keep")
    )
    return remove_rows(docs, stage(removed, "dedup-removed"), id_col, text_col)
