"""File sources: parquet tables and landed JSON documents (W02, W05)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from recordtable.sources.json_array import read_elements


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet table; filters and projections applied later are pushed into the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def doc_order(block: str = "_metadata.file_block_start") -> Column:
    """Order of documents inside a file: (byte offset of the file split, row id).

    Row ids rise with line order inside a split, and splits of one file are
    ordered by their offset, so with the file name this orders lines as
    they appear in the file (and is reproducible for the same files).
    """
    return F.struct(F.col(block).alias("block"), F.monotonically_increasing_id().alias("row"))


def read_documents(spark: SparkSession, path: str, layout: str = "lines", doc_col: str = "doc") -> DataFrame:
    """Landed JSON text -> ``(source_file, doc_order, doc)`` rows.

    ``layout="lines"``: one document per line (JSON Lines); files are split
    across tasks, so this scales with the input. ``layout="whole"``: one
    document per file (e.g. one JSON array per file, as an API returns it);
    each file is read by one task and must fit in one row (< 2 GB).
    ``layout="array"``: the elements of one JSON array (or the values of one
    object) per file are the documents, to be read with ``single=True``; files
    are split across tasks whatever their size, see ``json_array.read_elements``.
    """
    if layout == "array":
        order = F.struct(F.lit(0).cast("long").alias("block"), F.col("pos").alias("row"))
        return read_elements(spark, path).select("source_file", order.alias("doc_order"), F.col("element").alias(doc_col))
    if layout == "lines":
        df = spark.read.text(path)
    elif layout == "whole":
        df = spark.read.text(path, wholetext=True)
    else:
        raise ValueError(f"unknown layout {layout!r}; expected 'lines', 'whole' or 'array'")
    return df.select(
        F.col("_metadata.file_path").alias("source_file"), doc_order().alias("doc_order"), F.col("value").alias(doc_col)
    ).where(F.trim(F.col(doc_col)) != F.lit(""))
