"""Table contract: check it and fill defaults (W08)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.fields import Contract


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One metrics row: ``rows``, ``null_key``, ``duplicate_key``, ``null_<col>``, ``empty_<col>``, ``too_long_<col>``.

    ``duplicate_key`` is the number of non-NULL key values beyond the first
    for each key (``count(key) - count(distinct key)``). One pass; the
    distinct shuffles on the key across all partitions, everything else is
    a partial count per task.
    """
    k = F.col(contract.key)
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(k.isNull()).alias("null_key"),
        (F.count(k) - F.count_distinct(k)).alias("duplicate_key"),
    ]
    for c in contract.not_null:
        if c != contract.key:
            metrics.append(F.count_if(F.col(c).isNull()).alias(f"null_{c}"))
    for c in contract.not_empty:
        metrics.append(F.count_if(F.coalesce(F.col(c), F.lit("")) == F.lit("")).alias(f"empty_{c}"))
    for c, n in contract.max_len.items():
        metrics.append(F.count_if(F.length(F.col(c)) > F.lit(n)).alias(f"too_long_{c}"))
    return df.agg(*metrics)


def broken_rule(contract: Contract) -> Column:
    """The first rule that a row breaks, NULL if none: ``null_key``, ``null_<col>``, ``too_long_<col>``."""
    rules = [(F.col(contract.key).isNull(), "null_key")]
    rules += [(F.col(c).isNull(), f"null_{c}") for c in contract.not_null if c != contract.key]
    rules += [(F.length(F.col(c)) > F.lit(n), f"too_long_{c}") for c, n in contract.max_len.items()]
    return F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules])


def split_contract(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(rows that keep the contract, rows that break it)``; the latter with ``reason``, see :func:`broken_rule`.

    Row by row, so ``df`` is only filtered; uniqueness of the key is the change operators' matter.
    """
    marked = df.withColumn("reason", broken_rule(contract))
    return marked.where(F.col("reason").isNull()).drop("reason"), marked.where(F.col("reason").isNotNull())


def check_batch(df: DataFrame, key: str, seq: str) -> DataFrame:
    """One metrics row for a change batch: ``rows``, ``null_key``, ``null_seq``, ``duplicate_key_seq``.

    The change operators pick one row per key by ``seq``; ``duplicate_key_seq``
    (rows beyond the first for a repeated non-NULL ``(key, seq)`` pair)
    must be 0 for that pick to be exact. The distinct shuffles on the pair,
    so a hot key is spread by its ``seq`` values.
    """
    pair = F.struct(F.col(key), F.col(seq))
    both = F.col(key).isNotNull() & F.col(seq).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("null_key"),
        F.count_if(F.col(seq).isNull()).alias("null_seq"),
        (F.count_if(both) - F.count_distinct(F.when(both, pair))).alias("duplicate_key_seq"),
    )


def apply_defaults(df: DataFrame, contract: Contract, run_ts: datetime | None = None) -> DataFrame:
    """Fill NULLs with the contract defaults and stamp ``load_ts`` (``run_ts`` or the query start time)."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in contract.defaults:
            out.append(F.coalesce(F.col(c), F.lit(contract.defaults[c]).cast(types[c])).alias(c))
        elif c != contract.load_ts:
            out.append(F.col(c))
    if contract.load_ts:
        ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
        out.append(ts.alias(contract.load_ts))
    return df.select(*out)
