"""Sinks: append and safe overwrite to parquet or JDBC (W06, W07).

Overwriting a table with a plan that reads the same table loses data: the
target is emptied before the lazy read runs. Every sink is therefore overwritten
from a parquet copy under the session's shared checkpoint folder, which stays if the
overwrite fails. Stored tables (``recordtable.sources.tables``) also
remember that copy and finish from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from recordtable.session import ensure_checkpoint_dir, shared_path
from recordtable.sources.fs import delete_path
from recordtable.sources.jdbc import jdbc_write_options


@dataclass(frozen=True)
class ParquetSink:
    path: str
    partition_by: Sequence[str] = ()


@dataclass(frozen=True)
class JdbcSink:
    options: Mapping[str, Any]
    table: str
    num_partitions: int | None = None
    extra: Mapping[str, Any] = field(default_factory=dict)


Sink = ParquetSink | JdbcSink


def _write(df: DataFrame, sink: Sink, mode: str) -> None:
    if isinstance(sink, ParquetSink):
        w = df.write.mode(mode)
        if sink.partition_by:
            w = w.partitionBy(*sink.partition_by)
        w.parquet(sink.path)
    elif isinstance(sink, JdbcSink):
        opts = jdbc_write_options(sink.options, sink.table, overwrite=(mode == "overwrite"), num_partitions=sink.num_partitions)
        opts.update({str(k): str(v) for k, v in sink.extra.items()})
        df.write.mode(mode).format("jdbc").options(**opts).save()
    else:
        raise TypeError(f"unknown sink {sink!r}")


def append(df: DataFrame, sink: Sink, mode: str = "append") -> None:
    """Append rows (``mode="error"``: create, failing if the sink exists).

    Each task commits its own partition; JDBC appends are not atomic.
    """
    _write(df, sink, mode)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    What is read more than once is computed once, and a lost executor re-reads
    the written copy.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def overwrite_staged(
    spark: SparkSession,
    df: DataFrame,
    sink: Sink,
    stage_path: str | None = None,
    keep_stage: bool = False,
) -> str:
    """Replace the sink's contents with ``df`` safely, even when ``df`` reads the sink.

    Returns the path the rows were first written to, under ``spark.checkpoint.dir``
    (or ``stage_path``): removed after the overwrite unless ``keep_stage``.
    """
    ensure_checkpoint_dir(spark)
    path = stage_path or shared_path(spark, "stage")
    df.write.mode("error").parquet(path)
    _write(spark.read.schema(df.schema).parquet(path), sink, "overwrite")
    if not keep_stage:
        delete_path(spark, path)
    return path
