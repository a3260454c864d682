"""Stored tables: Parquet files written by Spark's writers, described by a catalog table.

The catalog table over a table's folder holds its schema and, as table
properties, its key and its number of buckets, so an emptied table still has a
schema and a table is not opened with another number of buckets. On a cluster with
a persistent catalog these survive the session; where the catalog does not know a
folder, it is registered from its files.

A new state is first written under the shared checkpoint folder and named in the
property ``recordtable.pending``; then Spark's writer puts it in place: a whole
overwrite of a flat table, a dynamic partition overwrite (only the buckets that have
rows) of a bucketed one. A bucket that the change emptied is removed after
that. Whatever fails on the way, the next command finds the pending copy and
writes it again: the same rows, so it may be repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from recordtable.session import ensure_checkpoint_dir, shared_path
from recordtable.sources.fs import delete_path, path_exists

BUCKET_COL = "_bucket"
_KEY, _BUCKETS, _PENDING, _EMPTIED, _SORT = (f"recordtable.{n}" for n in ("key", "buckets", "pending", "emptied", "sort"))


def table_name(path: str) -> str:
    """Name under which the folder is in the catalog."""
    return f"recordtable_{hashlib.sha256(path.rstrip('/').encode()).hexdigest()[:24]}"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(spark: SparkSession, path: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table_name(path)}").collect()
    return {r["key"]: r["value"] for r in rows}


def _set(spark: SparkSession, path: str, values: dict[str, str]) -> None:
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table_name(path)} SET TBLPROPERTIES ({listed})")


def register(spark: SparkSession, path: str, schema: StructType, key: str | None, buckets: int | None) -> None:
    """Catalog table over the folder; one that is there already stays."""
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f"PARTITIONED BY ({BUCKET_COL})" if buckets else ""
    facts = {_KEY: key or "", _BUCKETS: str(buckets or "")}
    listed = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in facts.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(path)} ({columns}) USING parquet {partitioned} "
        f"LOCATION {_quoted(path)} TBLPROPERTIES ({listed})"
    )


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table is stored at ``path``; finishes one that was being published."""
    if spark.catalog.tableExists(table_name(path)):
        recover(spark, path)
        if path_exists(spark, path):
            return True
        spark.sql(f"DROP TABLE IF EXISTS {table_name(path)}")  # its folder was removed by other means
    return path_exists(spark, path)


def stored_buckets(spark: SparkSession, path: str) -> int | None | str:
    """Number of buckets of the table (None: flat); ``"unknown"`` where only the files are known."""
    if not spark.catalog.tableExists(table_name(path)):
        return "unknown"
    buckets = _properties(spark, path).get(_BUCKETS, "")
    return int(buckets) if buckets else None


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``, also when it has no data files."""
    if not exists(spark, path):
        raise FileNotFoundError(f"no table at {path}")
    if not spark.catalog.tableExists(table_name(path)):
        return spark.read.parquet(path)
    return spark.read.schema(spark.table(table_name(path)).schema).parquet(path)


def _overwrite(staged: DataFrame, path: str, buckets: int | None) -> None:
    # one task per bucket; buckets without rows here are left as they are
    _write(staged.repartition(BUCKET_COL) if buckets else staged, path, buckets)


def _overwrite_sorted(staged: DataFrame, path: str, buckets: int | None, sort: list[str]) -> None:
    if buckets:
        _write(staged.repartition(BUCKET_COL).sortWithinPartitions(BUCKET_COL, *sort), path, buckets)
    else:  # each file is a range of the order
        _write(staged.repartitionByRange(*sort).sortWithinPartitions(*sort), path, buckets)


def _write(df: DataFrame, path: str, buckets: int | None) -> None:
    writer = df.write.mode("overwrite")
    if buckets:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COL)
    writer.parquet(path)


def _finish(spark: SparkSession, path: str, pending: str, buckets: int | None, emptied: list[int]) -> None:
    schema = spark.table(table_name(path)).schema
    sort = [c for c in _properties(spark, path).get(_SORT, "").split(",") if c]
    staged = spark.read.schema(schema).parquet(pending)
    if sort:
        _overwrite_sorted(staged, path, buckets, sort)
    else:
        _overwrite(staged, path, buckets)
    for bucket in emptied:
        delete_path(spark, f"{path.rstrip('/')}/{BUCKET_COL}={bucket}")
    if buckets:
        spark.sql(f"MSCK REPAIR TABLE {table_name(path)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table_name(path))
    spark.sql(f"ALTER TABLE {table_name(path)} UNSET TBLPROPERTIES IF EXISTS ({_quoted(_PENDING)}, {_quoted(_EMPTIED)})")
    delete_path(spark, pending)


def recover(spark: SparkSession, path: str) -> None:
    """Finish a publish that a failure cut short."""
    facts = _properties(spark, path)
    if _PENDING in facts:
        emptied = [int(b) for b in facts.get(_EMPTIED, "").split(",") if b]
        buckets = int(facts[_BUCKETS]) if facts.get(_BUCKETS) else None
        _finish(spark, path, facts[_PENDING], buckets, emptied)


def publish(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    key: str | None = None,
    buckets: int | None = None,
    touched: list[int] | None = None,
    sort: Sequence[str] = (),
) -> str:
    """Make ``df`` the table at ``path``, or with ``touched`` the content of those buckets; ``df`` may read the table.

    ``sort`` (column names without commas) orders the rows of a bucket's file, or of
    a flat table, whose files are then ranges of that order: files and row groups have narrow
    ranges to prune by. A table keeps its order when it is published without one.
    Returns the folder that held the staged copy.
    """
    ensure_checkpoint_dir(spark)
    pending = shared_path(spark, "publish")
    if buckets:  # the partition column comes last, as in the catalog table
        df = df.select(*[c for c in df.columns if c != BUCKET_COL], BUCKET_COL)
    df.write.mode("error").parquet(pending)
    register(spark, path, df.schema, key, buckets)
    emptied: list[int] = []
    if touched is not None:
        staged = spark.read.schema(df.schema).parquet(pending)
        filled = {r[0] for r in staged.select(BUCKET_COL).distinct().collect()}  # at most ``buckets`` numbers
        emptied = [b for b in touched if b not in filled]
    _set(spark, path, {_PENDING: pending, _EMPTIED: ",".join(map(str, emptied))} | ({_SORT: ",".join(sort)} if sort else {}))
    _finish(spark, path, pending, buckets, emptied)
    return pending
