"""Refresh pipeline (W18): landed documents -> checked, upserted, safely rewritten table.

documents -> explode_documents -> map (rename, list join) -> apply_defaults
-> split_contract -> upsert into the current table -> published by Spark's writers.

Running it twice on the same documents leaves the table unchanged (apart
from the load timestamp of the re-loaded rows): upsert is idempotent.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordtable.fields import Contract, Field
from recordtable.functions.json_rules import join_list
from recordtable.operators.change import upsert
from recordtable.operators.contract import apply_defaults, check_contract, split_contract
from recordtable.operators.ingest import explode_documents
from recordtable.session import shared_path
from recordtable.sources.layout import BUCKET_COL, in_buckets, overwrite_buckets, touched_buckets, with_bucket, write_bucketed
from recordtable.sources.sinks import ParquetSink, stage
from recordtable.sources.tables import publish


@dataclass
class RefreshResult:
    """``rows_loaded``: rows written, i.e. the whole table, or the touched buckets of a bucketed one."""

    contract_row: dict
    rejects: int
    rows_loaded: int
    stage: str | None
    rejects_path: str | None = None


def build_batch(
    documents: DataFrame,
    doc_col: str,
    fields: Sequence[Field],
    contract: Contract,
    run_ts: datetime | None = None,
    list_sep: str = ",",
    order_cols: Sequence[str] = ("source_file", "doc_order", "pos"),
    single: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Documents -> ``(rows in table shape with a ``__seq`` column, rejects)``.

    List fields are joined with ``list_sep``; ``__seq`` orders records
    (later file, later line, later position wins in the upsert). ``single``: each
    document is one record (JSON Lines of objects), see ``explode_documents``.
    """
    keep = [c for c in order_cols if c in documents.columns and c != "pos"]
    records, rejects = explode_documents(documents, doc_col, fields, keep=keep, single=single)
    cols = []
    for f in fields:
        c = F.col(f.out)
        cols.append(join_list(c, list_sep).alias(f.out) if f.kind == "list" else c)
    seq_parts = [F.col(c) for c in keep] + [F.col("pos")]
    batch = records.select(*cols, F.struct(*seq_parts).alias("__seq"))
    batch = apply_defaults(batch, contract, run_ts)
    return batch, rejects


def refresh(
    spark: SparkSession,
    documents: DataFrame,
    doc_col: str,
    fields: Sequence[Field],
    contract: Contract,
    target: ParquetSink,
    current: DataFrame | None = None,
    run_ts: datetime | None = None,
    buckets: int | None = None,
    single: bool = False,
    sort: Sequence[str] = (),
) -> RefreshResult:
    """Load documents into ``target``: upsert by key.

    ``current`` is the table now at ``target``, or None for a first load
    (then ``target`` must not exist yet). The batch is parsed once and staged;
    the load time is taken once.

    What could not be loaded is written under the shared checkpoint folder
    (``RefreshResult.rejects_path``): elements and documents that could not be
    read, and, as JSON text, records that break the contract (``null_key``,
    ``null_<col>``, ``too_long_<col>``). Elements = records loaded or replaced
    by a later one + rejects.

    ``sort``: the order in which a flat target is kept. With ``buckets``, the target uses the key-bucket layout
    (``recordtable.sources.layout``) and only the buckets holding incoming
    keys are read and rewritten.
    """
    run_ts = run_ts or datetime.now(timezone.utc)
    batch, rejects = build_batch(documents, doc_col, fields, contract, run_ts, single=single)
    if buckets:
        batch = with_bucket(batch, contract.key, buckets)
    batch = stage(batch, "refresh-batch")
    contract_row = check_contract(batch.drop("__seq"), contract).first().asDict()
    incoming, broken = split_contract(batch, contract)
    content = [c for c in broken.columns if c not in ("reason", "__seq", BUCKET_COL)]
    broken = broken.select(
        F.col("__seq.pos").alias("pos"), "reason", F.to_json(F.struct(*content)).alias("value")
    )
    rejects_path = shared_path(spark, "rejects")
    rejects.unionByName(broken, allowMissingColumns=True).write.parquet(rejects_path)
    n_rejects = spark.read.parquet(rejects_path).count()

    table_cols = [c for c in batch.columns if c != "__seq"]
    touched = touched_buckets(incoming, contract.key, buckets) if (buckets and current is not None) else None
    if current is None:
        base = incoming.limit(0).drop("__seq")
    elif touched is not None:  # only the buckets holding incoming keys are read
        base = in_buckets(current.select(*table_cols), touched, buckets)
        if 2 * len(touched) > buckets:  # all buckets are read
            touched = list(range(buckets))
    else:
        base = current.select(*table_cols)
    untied = [contract.load_ts] if contract.load_ts else []
    result, _ = upsert(base, incoming, contract.key, "__seq", untied=untied, staged=True)
    seen = Observation()
    result = result.select(*table_cols).observe(seen, F.count(F.lit(1)).alias("rows"))
    if touched is not None:
        written = overwrite_buckets(spark, result, target.path, contract.key, buckets, touched)
    elif buckets:
        written = write_bucketed(result, target.path, contract.key, buckets)
    else:
        written = publish(spark, result, target.path, contract.key, sort=sort)
    return RefreshResult(contract_row, n_rejects, seen.get["rows"], written, rejects_path)
