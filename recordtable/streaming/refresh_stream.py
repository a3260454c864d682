"""Continuous refresh: landed JSON files -> the keyed table, one micro-batch at a time.

Structured Streaming tracks which landed files were processed (file source
+ checkpoint); every micro-batch runs the batch refresh pipeline
(``recordtable.plans.refresh``) through ``foreachBatch``. The upsert is
idempotent, so a micro-batch replayed after a failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordtable.fields import Contract, Field
from recordtable.plans.refresh import refresh
from recordtable.session import shared_path
from recordtable.sources.files import doc_order
from recordtable.sources.sinks import ParquetSink
from recordtable.sources.tables import exists, read_stored


def start_refresh_stream(
    spark: SparkSession,
    landing_dir: str,
    fields: Sequence[Field],
    contract: Contract,
    target: ParquetSink,
    checkpoint_location: str | None = None,
    layout: str = "lines",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    buckets: int | None = None,
    single: bool = False,
) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what has landed and stops.

    With ``buckets`` the target keeps the key-bucket layout and each
    micro-batch rewrites only the buckets its keys fall in. ``single``: one
    record per line instead of one document per line.
    """
    reader = spark.readStream.format("text")
    if layout == "whole":
        reader = reader.option("wholetext", "true")
    elif layout != "lines":
        raise ValueError(f"unknown layout {layout!r}")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(landing_dir).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("doc"),
    ).where(F.trim(F.col("doc")) != F.lit(""))

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        batch = batch.withColumn("doc_order", doc_order("block")).drop("block")
        current = read_stored(spark, target.path) if exists(spark, target.path) else None
        refresh(spark, batch, "doc", fields, contract, target, current=current, buckets=buckets, single=single)

    writer = (
        docs.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint_location or shared_path(spark, "refresh-stream"))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
