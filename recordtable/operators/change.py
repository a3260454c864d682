"""Batch row changes on a keyed table (W14 patch, W15 insert/upsert, W17 delete).

Each function takes the current table and a change set and returns the new
table plus the changes it could not apply. The change set is computed once:
it is written under the shared checkpoint folder and every output reads that
copy (``staged=True`` says that the caller has done so); the table itself is
not written. The table
is never read and overwritten in one step: pass the result to
``recordtable.sources.sinks.overwrite_staged``.

Scale rules used throughout:

* In-batch duplicates are resolved with one ``min_by/max_by(row, order)``
  aggregation per key (partial aggregation inside each task, so a key
  holding a third of the batch is one row per task before the shuffle).
  The rejected rows of ``insert_new`` are classified by one left join of
  the batch to a per-key row. No window over the key.
* A change set proven small by a count is broadcast; the big table
  is then only scanned (key column only) with a broadcast filter and never
  shuffled. Larger change sets use shuffle joins on the key, where AQE
  splits skewed partitions.
* ``seq`` should be unique per key (``check_batch`` reports repeats); rows
  tied on ``seq`` are ordered by a hash of their content, so the pick is
  the same on every run and after any recomputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.fields import Field
from recordtable.functions.json_rules import has_field, join_list, read_field
from recordtable.operators.bitmaps import MAX_BITMAPS, is_integer_key, key_bitmaps, present_bitmaps, where_in_bitmaps
from recordtable.operators.joins import (
    DEFAULT_MAX_BROADCAST_BYTES,
    DEFAULT_MAX_BROADCAST_ROWS,
    bounded_bytes,
    bounded_rows,
    split_join,
)
from recordtable.sources.sinks import stage

_V = "__rt_v"


def _small(df: DataFrame, max_rows: int | None) -> bool:
    return bool(max_rows) and bounded_rows(df, max_rows) is not None


# Partition column of the key-bucket layout (recordtable.sources.layout).
# When both sides carry it, existence checks match on it as well as on the
# key; the store scopes the table to the touched buckets before calling the
# operators, so their scans are pruned to those bucket folders.
_BUCKET = "_bucket"


def _join_cols(table: DataFrame, other: DataFrame, key: str) -> list[str]:
    return [key, _BUCKET] if _BUCKET in table.columns and _BUCKET in other.columns else [key]


def _present_keys(table: DataFrame, keys: DataFrame, key: str, small: bool) -> DataFrame:
    """Keys of ``table`` that occur in ``keys`` (with the bucket column when both have it).

    Small ``keys``: a broadcast semi join over the table's key column, then a
    distinct (local dedup in each task first), so the result has at most as
    many rows as ``keys`` and may itself be broadcast. Otherwise the table's
    distinct keys, for a shuffle join: the build side of the anti/semi join
    then holds each key once, even when the table repeats a key many times.
    """
    cols = _join_cols(table, keys, key)
    tk = table.select(*cols)
    if not small:
        return tk.select(key).distinct()
    return tk.join(F.broadcast(keys.select(*cols)), cols, "left_semi").select(key).distinct()


def _side(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


_ORD = "__rt_ord"


def _with_order(df: DataFrame, seq: str, untied: Sequence[str] = ()) -> DataFrame:
    """Add a total order for picking rows: ``(seq, xxhash64(row))``.

    ``untied``: columns that must not decide a tie (a load time differs from run to run).

    Rows tied on ``seq`` are told apart by their content, so the pick does not
    depend on input order and a recomputed partition picks the same row.
    Rows tied on both are identical, and either pick gives the same result.
    Map columns cannot be hashed and are left out of the hash.
    """
    hashable = [F.col(c) for c, t in df.dtypes if not t.startswith("map<") and c not in untied]
    return df.withColumn(_ORD, F.struct(F.col(seq).alias("s"), F.xxhash64(*hashable).alias("h")))


def _batch_winners(incoming: DataFrame, key: str, pick: str) -> DataFrame:
    """One row per key: the first (``pick="first"``) or last row by ``_ORD``.

    A single aggregation carrying the whole row as a struct: each task
    keeps one row per key before the shuffle (a hot key costs one row per
    task), and there is no join back to the batch.
    """
    row = F.struct(*[F.col(c) for c in incoming.columns])
    agg = F.min_by(row, F.col(_ORD)) if pick == "first" else F.max_by(row, F.col(_ORD))
    return incoming.groupBy(key).agg(agg.alias("__rt_w")).select("__rt_w.*")


def _ordered(incoming: DataFrame, seq: str, untied: Sequence[str], staged: bool) -> DataFrame:
    ordered = _with_order(incoming, seq, untied)
    return ordered if staged else stage(ordered, "batch")


def _unusable(ordered: DataFrame, key: str, seq: str) -> Column:
    return F.when(F.col(key).isNull(), F.lit("null_key")).when(F.col(seq).isNull(), F.lit("null_seq"))


def insert_new(
    table: DataFrame,
    incoming: DataFrame,
    key: str,
    seq: str,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    untied: Sequence[str] = (),
    staged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Add rows whose key is new; never replace.

    Inside the batch the first row by ``seq`` wins per key. Returns
    ``(result, rejected)``: ``result`` has the table's columns; ``rejected``
    has the incoming columns plus ``reason`` = ``key_exists``,
    ``duplicate_in_batch``, ``null_seq`` or ``null_key``. Rows of result plus rows of
    rejected = rows of table plus rows of incoming (rows repeated exactly,
    same key, seq and values, count once).
    """
    ordered = _ordered(incoming, seq, untied, staged)
    small = _small(ordered.select(key), max_broadcast_rows)
    valid = ordered.where(F.col(key).isNotNull() & F.col(seq).isNotNull())
    winners = _batch_winners(valid, key, "first")
    keys = valid.select(*_join_cols(table, valid, key))
    present = _side(_present_keys(table, keys, key, small), small)
    new = winners.join(present, key, "left_anti")
    result = table.unionByName(new.select(*table.columns))

    # One pass over the batch classifies every rejected row: a per-key row
    # (winning order, key already in the table) joined to the batch on the key.
    info = winners.select(F.col(key), F.col(_ORD).alias("__rt_first")).join(
        present.select(F.col(key), F.lit(True).alias("__rt_exists")), key, "left"
    )
    reason = (
        F.coalesce(_unusable(ordered, key, seq), F.when(F.col(_ORD) != F.col("__rt_first"), F.lit("duplicate_in_batch")),
                   F.when(F.col("__rt_exists"), F.lit("key_exists")))
    )
    joined = ordered.join(F.broadcast(info), key, "left") if small else split_join(ordered, info, key, "left")
    rejected = joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*incoming.columns, "reason")
    return result, rejected


def upsert(
    table: DataFrame,
    incoming: DataFrame,
    key: str,
    seq: str,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    untied: Sequence[str] = (),
    staged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Insert new keys and replace existing ones; the last row by ``seq`` wins per key.

    Returns ``(result, rejected)``; ``rejected`` holds the rows that cannot
    be used, with ``reason`` = ``null_key`` or ``null_seq``. Idempotent:
    upserting the same batch twice gives the same table as once.
    """
    ordered = _ordered(incoming, seq, untied, staged)
    small = _small(ordered.select(key), max_broadcast_rows)
    valid = ordered.where(F.col(key).isNotNull() & F.col(seq).isNotNull())
    winners = _batch_winners(valid, key, "last")
    # the keys of the staged batch, one per key
    drop_keys = _side(valid.select(key).distinct(), small)
    kept = table.join(drop_keys, key, "left_anti")
    unusable = ordered.withColumn("reason", _unusable(ordered, key, seq)).where(F.col("reason").isNotNull())
    return kept.unionByName(winners.select(*table.columns)), unusable.select(*incoming.columns, "reason")


def delete(
    table: DataFrame,
    keys: DataFrame,
    key: str,
    keys_key: str | None = None,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    max_bitmaps: int = MAX_BITMAPS,
) -> tuple[DataFrame, DataFrame]:
    """Remove every row whose key is in ``keys``.

    Returns ``(result, missing)``: ``missing`` holds the requested keys (one
    row per request) that matched no row. Integer keys beyond
    ``max_broadcast_rows`` are broadcast as bitmaps where ``max_bitmaps``
    hold them, so the table is not shuffled; others use a shuffle join.
    """
    wanted = keys.select(F.col(keys_key or key).alias(key)).where(F.col(key).isNotNull())
    small = _small(wanted, max_broadcast_rows)
    bitmaps = None if small or not is_integer_key(table, key) else key_bitmaps(wanted, key, max_bitmaps)
    if bitmaps is not None:
        result = where_in_bitmaps(table, key, bitmaps, present=False)
        missing = where_in_bitmaps(wanted, key, present_bitmaps(table, key, bitmaps), present=False)
    else:
        result = table.join(F.broadcast(wanted) if small else wanted.distinct(), key, "left_anti")
        present = _side(_present_keys(table, wanted, key, small), small)
        missing = wanted.join(present, key, "left_anti")
    if keys_key and keys_key != key:
        missing = missing.withColumnRenamed(key, keys_key)
    return result, missing


def _wrapped(f: Field) -> bool:
    """Whether a field's folded value needs a struct wrapper.

    A numeric field with a default is never NULL when a patch mentions it,
    so a NULL fold already means "not mentioned" and the bare value is kept.
    Text, list and default-less fields can be NULL and are wrapped as
    ``{v}`` (``{NULL}`` = set to NULL, NULL = not mentioned).
    """
    return not (f.kind in ("int", "long", "double") and f.default is not None)


def fold_patches(
    patches: DataFrame,
    key: str,
    seq: str,
    json_col: str,
    fields: Sequence[Field],
    list_sep: str | None = ",",
) -> DataFrame:
    """One row per key: for each field, the value from the last patch (by ``seq``) that has it.

    Column ``__p_<column>`` is NULL when no patch has the field; otherwise it
    holds the value (an explicit JSON null gives the field default), wrapped
    as a struct ``{v}`` for fields that ``_wrapped`` says need it. List
    fields are joined with ``list_sep`` (``None`` keeps the array).
    ``max_by`` aggregates partially inside each task.
    """
    # order: seq, then the patch text, so patches tied on seq are picked the same way every time
    order = F.struct(F.col(seq).alias("s"), F.xxhash64(F.col(json_col)).alias("h"))
    parsed = patches.select(F.col(key), order.alias(_ORD), F.try_parse_json(F.col(json_col)).alias(_V))
    v = F.col(_V)

    def value(f: Field):
        c = read_field(v, f)
        c = join_list(c, list_sep) if (f.kind == "list" and list_sep is not None) else c
        return F.struct(c.alias("v")) if _wrapped(f) else c

    aggs = [
        F.max_by(value(f), F.when(has_field(v, f.name), F.col(_ORD))).alias(f"__p_{f.out}")
        for f in fields
    ]
    return parsed.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def patch(
    table: DataFrame,
    patches: DataFrame,
    key: str,
    seq: str,
    json_col: str,
    fields: Sequence[Field],
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
    list_sep: str | None = ",",
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Apply partial updates ``(key, seq, json)`` field by field.

    A field takes the value of the last patch (by ``seq``) that mentions it;
    fields no patch mentions keep the stored value; an explicit null sets
    the field default. Keys in the JSON are ignored except the ``fields``
    given. The folded patches (one row per key) are staged and broadcast only
    if their measured bytes are within ``max_broadcast_bytes``. Returns ``(result, missing)``; ``missing`` holds the patch rows
    whose key is not in the table.
    """
    unknown = [f.out for f in fields if f.out not in table.columns]
    if unknown:
        raise ValueError(f"patch fields target columns the table does not have: {unknown}")
    folded = stage(fold_patches(patches, key, seq, json_col, fields, list_sep), "patches")
    small = _small(folded.select(key), max_broadcast_rows)
    types = dict((f.name, f.dataType.simpleString()) for f in table.schema.fields)
    patched = {f.out: f for f in fields}
    narrow = small and bounded_bytes(folded, max_broadcast_bytes)
    joined = table.join(_side(folded, narrow), key, "left")
    out = []
    for c in table.columns:
        if c in patched:
            p = F.col(f"__p_{c}")
            new = p.getField("v") if _wrapped(patched[c]) else p
            out.append(F.when(p.isNotNull(), new.cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    result = joined.select(*out)
    keys = folded.select(key)
    if _BUCKET in patches.columns:
        keys = patches.where(F.col(key).isNotNull()).select(key, _BUCKET).distinct()
    present = _side(_present_keys(table, keys, key, small), small)
    missing = patches.join(present, key, "left_anti")
    return result, missing
