"""Reads over a keyed table (W09-W13, W16).

Every function returns a lazy DataFrame; none runs an action except the
row count that decides whether a key set may be broadcast. Filters are
column expressions, so Catalyst pushes them to the scan; projections are
explicit, so only the needed columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordtable.functions.collations import collated, contains_pattern, plain
from recordtable.functions.sql_functions import register_functions
from recordtable.operators.bitmaps import is_integer_key, key_bitmaps, where_in_bitmaps
from recordtable.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, key_set
from recordtable.sources.sinks import stage


# Up to this many rows a listing is a top-n, merged in one place; a longer one is a range sort.
TOP_N_ROWS = 10_000


def _check_limit(n: Any) -> int:
    if isinstance(n, bool) or not isinstance(n, int):
        raise ValueError(f"limit must be an integer, got {n!r}")
    if n < 0:
        raise ValueError(f"limit must be >= 0, got {n}")
    return n


def count_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """One-row DataFrame with the row count (partial counts per task, one final merge)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def key_counts(
    df: DataFrame,
    key: str,
    keys: DataFrame,
    keys_key: str | None = None,
    name: str = "n",
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Number of rows in ``df`` for every row of ``keys``; 0 where none match.

    A key set proven small is broadcast and filters ``df`` inside the scan
    stage before counting. A large key set is not: ``df`` is counted per key
    first (partial counts per task, so a hot key is one row per task before
    the shuffle) and the much smaller counts are joined to the keys.
    """
    keys_key = keys_key or key
    wanted = keys.select(F.col(keys_key).alias(key))
    ks, small = key_set(wanted, key, max_broadcast_rows)
    rows = df.select(key)
    if small:
        rows = rows.join(ks, key, "left_semi")
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    if small:  # at most one row per requested key: proven small as well
        counts = F.broadcast(counts)
    return (
        wanted.join(counts, key, "left")
        .select(F.col(key).alias(keys_key), F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name))
    )


def _sort_cols(order_by: Sequence[str | Column], key: str | None, df: DataFrame | None = None, collation: str | None = None) -> list[Column]:
    if collation is not None:  # the texts among the columns
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
        order_by = [collated(c, collation).asc_nulls_first() if c in text else c for c in order_by]
    cols = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order_by]
    if key is not None and key not in [c for c in order_by if isinstance(c, str)]:
        cols.append(F.col(key).asc())
    return cols


def list_rows(
    df: DataFrame,
    cols: Sequence[str],
    order_by: Sequence[str | Column],
    n: int = 10,
    key: str | None = None,
    top_n: int = TOP_N_ROWS,
    collation: str | None = None,
) -> DataFrame:
    """First ``n`` rows by ``order_by`` (nulls first, texts by ``collation`` if given), key as last tie-break.

    Up to ``top_n`` rows this plans as TakeOrderedAndProject: every task keeps
    its own top ``n`` and only those reach the final merge, so the cost is one
    scan. A longer list has the same rows but passes through no single task:
    rows are range-partitioned and staged, each partition numbers its own rows
    and keeps those whose place, by the row counts of the partitions before
    it, is below ``n``.
    """
    n = _check_limit(n)
    order = _sort_cols(order_by, key, df, collation)
    if n <= top_n:
        return df.select(*cols).orderBy(*order).limit(n)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.select(*cols).repartitionByRange(parts, *order)
    ranged = stage(ranged.withColumn("__rt_part", F.spark_partition_id()), "list")
    counts = {r["__rt_part"]: r["n"] for r in ranged.groupBy("__rt_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, starts = 0, []  # one number per partition
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    starts = df.sparkSession.createDataFrame(starts, "__rt_part int, __rt_start long")
    own = F.row_number().over(Window.partitionBy("__rt_part").orderBy(*order))
    kept = ranged.join(F.broadcast(starts), "__rt_part").withColumn("__rt_n", own + F.col("__rt_start"))
    return kept.where(F.col("__rt_n") <= n).select(*cols).orderBy(*order)


def lookup(
    df: DataFrame,
    key: str,
    value: Any = None,
    keys: DataFrame | None = None,
    keys_key: str | None = None,
    max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Rows whose key equals ``value``, or whose key is in ``keys`` (semi join; integer keys too many to broadcast: bitmaps)."""
    if keys is None:
        if value is None:
            raise ValueError("lookup needs a value or a keys DataFrame")
        return df.where(F.col(key) == F.lit(value))
    wanted = keys.select(F.col(keys_key or key).alias(key))
    ks, small = key_set(wanted, key, max_broadcast_rows)
    bitmaps = None if small or not is_integer_key(df, key) else key_bitmaps(wanted, key)
    return where_in_bitmaps(df, key, bitmaps) if bitmaps is not None else df.join(ks, key, "left_semi")


def find(
    df: DataFrame,
    col: str,
    text: str,
    mode: str = "like",
    ignore_case: bool = False,
    cols: Sequence[str] | None = None,
    order_by: Sequence[str] | None = None,
    key: str | None = None,
    order: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """Rows whose ``col`` contains ``text``.

    ``mode="like"``: ``text`` is placed inside ``%...%`` and its own ``%``
    and ``_`` act as wildcards (a backslash is matched literally).
    ``mode="literal"``: plain substring.
    ``ignore_case`` lowers both sides; ``collation`` compares and sorts as that
    collation does (see ``functions.collations``). ``text`` is always a bound literal,
    never spliced into SQL. NULL values never match. Sorted by
    ``order_by`` (default ``col``) with ``key`` as tie-break when given;
    ``order=False`` leaves the matches as they are found. A range sort reads
    its input twice (once for the bounds), so the matches are first
    exchanged on the key: the table itself is scanned once.
    """
    if text is None:
        raise ValueError("find needs a search text")
    c = F.col(col)
    t = text
    if ignore_case and collation is not None:
        raise ValueError("a collation has its own rule for case")
    if ignore_case:
        c, t = F.lower(c), text.lower()
    if collation is not None:
        cond = contains_pattern(c, text, mode, collation)
    elif mode == "like":
        # % and _ stay wildcards; a backslash is data, not LIKE's escape
        cond = c.like("%" + t.replace("\\", "\\\\") + "%")
    elif mode == "literal":
        cond = c.contains(F.lit(t))
    else:
        raise ValueError(f"unknown find mode {mode!r}")
    out = df.where(cond)
    if cols is not None:
        out = out.select(*cols)
    if not order:
        return out
    by = list(order_by) if order_by is not None else [col]
    return out.repartition(F.col(key if key is not None else by[0])).orderBy(*_sort_cols(by, key, out, collation))


def group_stats(
    df: DataFrame,
    key: str,
    avg_cols: Mapping[str, str] | Sequence[str],
    count_name: str = "n",
    digits: int | None = None,
    order: bool = True,
    collation: str | None = None,
) -> DataFrame:
    """Rows and averages per ``key`` value; NULL key is a group of its own.

    With ``collation`` the keys it holds equal are one group, named by the least of them (by bytes).

    ``avg_cols`` is ``{column: output name}`` or a list (names ``avg_<col>``).
    Averages skip NULLs and are doubles; ``digits`` rounds them. Sorted by
    count descending, then key. Plans as partial + final HashAggregate, so
    a hot key is combined inside each task before the shuffle.
    """
    if not isinstance(avg_cols, Mapping):
        avg_cols = {c: f"avg_{c}" for c in avg_cols}
    aggs = [F.count(F.lit(1)).alias(count_name)]
    for c, name in avg_cols.items():
        a = F.avg(F.col(c))
        if digits is not None:
            a = F.round(a, digits)
        aggs.append(a.alias(name))
    if collation is None:
        out = df.groupBy(key).agg(*aggs)
    else:
        named = df.groupBy(collated(key, collation).alias("__rt_group")).agg(F.min(plain(key)).alias(key), *aggs)
        out = named.drop("__rt_group")
    if order:
        out = out.orderBy(F.col(count_name).desc(), collated(key, collation).asc_nulls_first())
    return out


def run_sql(
    spark: SparkSession,
    sql: str,
    views: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, Any] | Sequence[Any] | None = None,
    functions: bool = False,
) -> DataFrame:
    """Register ``views`` as temp views and run ``sql`` with bound ``args`` (``:name`` or ``?``).

    ``functions``: the coercion rules are known as SQL functions (see ``functions.sql_functions``).
    """
    if functions:
        register_functions(spark)
    for name, view in (views or {}).items():
        view.createOrReplaceTempView(name)
    return spark.sql(sql, args=args) if args else spark.sql(sql)
