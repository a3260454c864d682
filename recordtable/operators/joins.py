"""Join-side helpers.

Broadcasting is only done for a side whose row count has been *proven*
small by a count; anything larger is left to a shuffle join, where AQE may
still switch to a broadcast from measured stage sizes and splits skewed
partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default bound for narrow key sets (a few bigint columns): 2M rows stay well
# under the usual executor broadcast budget.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Bound for sides with text: what a driver and every executor can hold beside their work.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def bounded_rows(df: DataFrame, max_rows: int) -> int | None:
    """Row count of ``df`` if it is at most ``max_rows``, else None.

    A plain ``count()`` over no columns: each task counts its rows and one
    reducer adds up one number per task. It costs one pass over ``df`` (the
    change or key set, never the big table it is joined to). A
    ``limit(max_rows + 1).count()`` is not used: it plans as a per-task
    limit feeding up to ``max_rows + 1`` rows *per task* into a single
    partition, which grows with the number of tasks.
    """
    if max_rows < 0:
        return None
    n = df.select(F.lit(1).alias("one")).count()
    return n if n <= max_rows else None


def bounded_bytes(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows of ``df`` take at most ``max_bytes``: 16 bytes a value plus the JSON text of the rows.

    One pass over ``df`` (a staged change set, never the big table).
    """
    width = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns]))) + F.lit(16 * len(df.columns))
    return (df.agg(F.sum(width)).first()[0] or 0) <= max_bytes


def split_join(many: DataFrame, few: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on ``key`` where ``few`` has a row per key and ``many`` may hold a hot key.

    With the hash beside the key Spark exchanges both sides anew for the
    join; only then can AQE split a hot key's rows over several tasks.
    """
    hashed = F.xxhash64(F.col(key))
    return many.withColumn("__rt_j", hashed).join(few.withColumn("__rt_j", hashed), ["__rt_j", key], how).drop("__rt_j")


def key_set(
    keys: DataFrame, key: str, max_broadcast_rows: int | None = DEFAULT_MAX_BROADCAST_ROWS
) -> tuple[DataFrame, bool]:
    """Project ``keys`` to one key column without NULLs; broadcast it if proven small.

    Returns ``(keys, broadcast)``. Duplicate keys do not change semi/anti
    joins. A set too big to broadcast is made distinct: the partial
    aggregate collapses a hot key inside each task, and the join reuses the
    aggregate's hash partitioning, so no exchange is added and no join task
    receives a hot key's duplicates.
    """
    ks = keys.select(F.col(key)).where(F.col(key).isNotNull())
    if max_broadcast_rows and bounded_rows(ks, max_broadcast_rows) is not None:
        return F.broadcast(ks), True
    return ks.distinct(), False
