"""Continuous add / update / delete: landed change files -> ``RecordStore`` commands per micro-batch.

Each landed file holds change rows (JSON Lines or parquet) with the columns
the command takes: add ``(seq, json)``, update ``(<key>, seq, json)``,
delete ``(<key>)``, or all of them in one ordered stream: apply ``(op, seq,
<key>, json)``. Run one stream per table: separate streams that write the
same table do not see each other. Structured Streaming tracks which files were applied;
every micro-batch runs the batch command through ``foreachBatch``. The
first three commands are idempotent, so a micro-batch replayed after a failure leaves
the same table: a replayed add is rejected as existing keys, a replayed
patch sets the same values again, a replayed delete finds nothing. A replayed
``apply`` gives the same rows too, unless a patch stands before the add of a
key that was not there: the first time it found nothing, now it finds the row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from recordtable.plans.commands import RecordStore
from recordtable.session import shared_path

COMMANDS = ("add", "update", "delete", "apply")


def start_change_stream(
    store: RecordStore,
    landing_dir: str,
    command: str,
    schema: StructType | str,
    checkpoint_location: str | None = None,
    file_format: str = "json",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Apply ``command`` to every micro-batch of files landing in ``landing_dir``.

    The rows each command could not apply (rejected adds, patches or deletes
    for unknown keys) are written by the store under its report folder.
    """
    if command not in COMMANDS:
        raise ValueError(f"unknown command {command!r}; expected one of {COMMANDS}")
    spark = store.spark
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    changes = reader.load(landing_dir)

    def apply_batch(batch: DataFrame, epoch_id: int) -> None:
        if command == "add":
            store.add(batch)
        elif command == "update":
            store.update(batch)
        elif command == "apply":
            store.apply(batch)
        else:
            store.delete(batch)

    writer = changes.writeStream.foreachBatch(apply_batch).option(
        "checkpointLocation", checkpoint_location or shared_path(spark, f"{command}-stream")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
