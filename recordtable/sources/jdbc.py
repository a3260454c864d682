"""JDBC source and sink options (W05, W06, W07 for databases).

A JDBC read without partition options is one task over the whole table;
``read_jdbc`` always asks for a partitioned read when a numeric/date
column and bounds are given, so the scan is split into ``num_partitions``
range queries. Credentials come from the caller's ``options``.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def jdbc_read_options(
    options: Mapping[str, Any],
    table: str,
    partition: tuple[str, Any, Any, int] | None = None,
    fetchsize: int = 10_000,
) -> dict[str, str]:
    """Reader options; ``partition = (column, lower, upper, num_partitions)``.

    The bounds only decide the stride of the range queries: rows outside
    them are still read (by the first and last partition).
    """
    opts = {str(k): str(v) for k, v in options.items()}
    opts["dbtable"] = table
    opts.setdefault("fetchsize", str(fetchsize))
    if partition is not None:
        column, lower, upper, n = partition
        if int(n) < 1:
            raise ValueError("num_partitions must be >= 1")
        opts.update(
            partitionColumn=column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(int(n)),
        )
    return opts


def read_jdbc(
    spark: SparkSession,
    options: Mapping[str, Any],
    table: str,
    partition: tuple[str, Any, Any, int] | None = None,
    fetchsize: int = 10_000,
    single_task: bool = False,
) -> DataFrame:
    """Partitioned JDBC scan; filters and column pruning are pushed to the database.

    Without ``partition`` (column, lower, upper, tasks) one task would read the
    whole table; ``single_task=True`` says that it is small enough for that.
    """
    if partition is None and not single_task:
        raise ValueError("give partition bounds, or single_task=True for a small table")
    return spark.read.format("jdbc").options(**jdbc_read_options(options, table, partition, fetchsize)).load()


def jdbc_write_options(
    options: Mapping[str, Any],
    table: str,
    overwrite: bool = False,
    batchsize: int = 10_000,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Writer options. Overwrite uses ``truncate=true`` so the table keeps its DDL (key, defaults)."""
    opts = {str(k): str(v) for k, v in options.items()}
    opts["dbtable"] = table
    opts.setdefault("batchsize", str(batchsize))
    if overwrite:
        opts["truncate"] = "true"
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    return opts
