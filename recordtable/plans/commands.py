"""The original tool's data commands as DataFrame functions over a stored keyed table.

``RecordStore`` binds a parquet table path to its field spec and contract
and offers list / view / find / stats / query (lazy reads) and add /
update / delete / download (batch changes written with a staged
overwrite). Every change command takes a DataFrame batch of any size; the
one-record forms of the original tool are one-row batches.

Change commands compute what they could not apply *before* the table is
replaced and write it under the shared checkpoint folder, so the returned
DataFrame never re-reads the new table.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.fields import HERO_CONTRACT, HERO_FIELDS, Contract, Field
from recordtable.functions.json_rules import join_list
from recordtable.operators import change, read
from recordtable.operators.contract import apply_defaults, check_batch, split_contract
from recordtable.operators.joins import split_join
from recordtable.operators.ingest import parse_records
from recordtable.plans.refresh import RefreshResult, refresh
from recordtable.session import shared_path
from recordtable.sources import clustered, tables, text_index
from recordtable.sources.layout import BUCKET_COL, bucket_of, in_buckets, overwrite_buckets, touched_buckets, with_bucket, write_bucketed
from recordtable.sources.sinks import ParquetSink, stage

# ---------------------------------------------------------------------------
# The original tool's projections, sort column, statistics
# and view name for the record table.
# ---------------------------------------------------------------------------
HERO_LIST_COLS = (
    "hero_id", "hero_name", "base_health", "base_mana",
    "base_attack_min", "base_attack_max", "move_speed", "primary_attribute",
)
HERO_FIND_COLS = ("hero_id", "hero_name", "base_health", "move_speed", "primary_attribute")
HERO_NAME_COL = "hero_name"
HERO_STATS_KEY = "primary_attribute"
HERO_STATS_COUNT = "hero_count"
HERO_STATS_AVGS = {"base_health": "avg_health", "base_mana": "avg_mana", "move_speed": "avg_speed"}
HERO_VIEW = "heroes"
HERO_LIST_DEFAULT = 10


@dataclass
class RecordStore:
    spark: SparkSession
    path: str
    fields: Sequence[Field] = HERO_FIELDS
    contract: Contract = HERO_CONTRACT
    name_col: str = HERO_NAME_COL
    list_cols: Sequence[str] = HERO_LIST_COLS
    find_cols: Sequence[str] = HERO_FIND_COLS
    stats_key: str = HERO_STATS_KEY
    stats_count: str = HERO_STATS_COUNT
    stats_avgs: Mapping[str, str] = field(default_factory=lambda: dict(HERO_STATS_AVGS))
    view: str = HERO_VIEW
    list_sep: str = ","
    # Key-bucket layout: None = one flat parquet table rewritten whole on every
    # change; n = partitioned into n key buckets, changes rewrite only the
    # buckets they touch and key lookups read one bucket.
    buckets: int | None = None
    # A flat table kept in the order of its listing (name, key), to be read by pages.
    clustered: bool = False
    # Collation under which list, find and stats compare texts (None: by bytes).
    collation: str | None = None
    # Where add/update/delete write the rows they could not apply (default:
    # a fresh folder under the shared spark.checkpoint.dir). Kept for the caller.
    report_dir: str | None = None

    # -- reads ---------------------------------------------------------------
    def raw_table(self) -> DataFrame:
        """The stored table, with the layout's ``_bucket`` column when bucketed."""
        stored = tables.stored_buckets(self.spark, self.path)
        if stored not in ("unknown", self.buckets):
            raise ValueError(f"the table at {self.path} has buckets={stored}, opened with {self.buckets}")
        return tables.read_stored(self.spark, self.path)

    def table(self) -> DataFrame:
        """The table as users see it (no layout columns)."""
        raw = self.raw_table()
        return raw.drop(BUCKET_COL) if BUCKET_COL in raw.columns else raw

    def list(self, n: int = HERO_LIST_DEFAULT) -> DataFrame:
        return read.list_rows(self.table(), self.list_cols, [self.name_col], n, key=self.contract.key, collation=self.collation)

    def page(self, n: int = HERO_LIST_DEFAULT, after: tuple[Any, Any] | None = None) -> DataFrame:
        """The ``n`` rows behind ``after``, the (name, key) of the last row seen; by bytes, whatever the collation."""
        if not self.clustered:
            raise ValueError("pages need a table opened with clustered=True")
        return clustered.page(self.spark, self.path, self.list_cols, [self.name_col], self.contract.key, n, after)

    def index_names(self, ignore_case: bool = False) -> list[int] | None:
        """Make or bring up to date the trigram index that ``find`` uses (bucketed tables); see ``text_index``."""
        return text_index.index_text(self.spark, self.path, self.contract.key, self.name_col, ignore_case)

    def view_one(self, key_value: Any) -> DataFrame:
        if not self.buckets:
            return read.lookup(self.table(), self.contract.key, key_value)
        t = self.raw_table().where(F.col(BUCKET_COL) == bucket_of(F.lit(key_value), self.buckets))
        return read.lookup(t, self.contract.key, key_value).drop(BUCKET_COL)

    def find(self, text: str, mode: str = "like", ignore_case: bool = False) -> DataFrame:
        table, key = self.table(), self.contract.key
        if self.buckets and self.collation is None:
            return text_index.find_indexed(self.spark, self.path, key, self.name_col, text, mode, ignore_case, cols=self.find_cols)
        return read.find(table, self.name_col, text, mode, ignore_case, cols=self.find_cols, key=key, collation=self.collation)

    def stats(self) -> DataFrame:
        return read.group_stats(self.table(), self.stats_key, self.stats_avgs, self.stats_count, collation=self.collation)

    def count(self) -> DataFrame:
        return read.count_rows(self.table())

    def query(self, sql: str, args: Mapping[str, Any] | None = None) -> DataFrame:
        return read.run_sql(self.spark, sql, {self.view: self.table()}, args, functions=True)

    # -- changes -------------------------------------------------------------
    def _table_shape(self, records: DataFrame, run_ts: datetime | None) -> DataFrame:
        cols = [join_list(f.out, self.list_sep).alias(f.out) if f.kind == "list" else F.col(f.out) for f in self.fields]
        return apply_defaults(records.select(*cols, *[c for c in records.columns if c == "seq"]), self.contract, run_ts)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        if self.report_dir:
            out = f"{self.report_dir.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        else:
            out = shared_path(self.spark, name)
        df.drop(BUCKET_COL).write.parquet(out)
        return self.spark.read.parquet(out)

    def exists(self) -> bool:
        return tables.exists(self.spark, self.path)

    def _require(self) -> None:
        if not self.exists():
            raise FileNotFoundError(f"no table at {self.path}; load it with add() or download() first")

    def _scope(self, changed: DataFrame, key: str) -> tuple[DataFrame, list[int] | None]:
        """The part of the table a change can affect: all of it, or the buckets of the changed keys.

        Every key of the change set lives in a touched bucket, so existence
        checks against the scoped table are exact, and every scan of it is
        pruned to those bucket directories.
        """
        if not self.buckets:
            return self.table(), None
        touched = touched_buckets(changed, key, self.buckets)
        return in_buckets(self.raw_table(), touched, self.buckets), touched

    def _replace(self, result: DataFrame, touched: list[int] | None, first: bool = False) -> None:
        """Publish the new table, whole (flat layout) or only the touched buckets."""
        if touched is not None and not first:
            if 2 * len(touched) > self.buckets:  # all buckets were read
                touched = list(range(self.buckets))
            overwrite_buckets(self.spark, result, self.path, self.contract.key, self.buckets, touched)
        elif self.buckets:
            write_bucketed(result, self.path, self.contract.key, self.buckets)
        elif self.clustered:
            clustered.cluster_table(self.spark, result, self.path, [self.name_col], self.contract.key)
        else:
            tables.publish(self.spark, result, self.path, self.contract.key)

    @staticmethod
    def _check(batch: DataFrame, key: str, seq: str) -> None:
        row = check_batch(batch, key, seq).first()
        if row.duplicate_key_seq:
            raise ValueError(f"{row.duplicate_key_seq} rows repeat a ({key}, {seq}) pair; seq must order each key")

    def add(self, records: DataFrame, json_col: str = "json", seq: str = "seq",
            run_ts: datetime | None = None, check: bool = False) -> DataFrame:
        """Insert records (one JSON object per row, ordered by ``seq``) whose key is new.

        Returns the rejected rows (existing key, in-batch duplicate, no key,
        or a broken rule of the contract). The batch is parsed once and
        staged, and the load time is taken once and decides no tie.
        ``check=True`` first refuses a batch that repeats a (key, seq) pair.
        """
        parsed = parse_records(records, json_col, self.fields, keep=[seq])
        incoming = self._table_shape(parsed.withColumnRenamed(seq, "seq"), run_ts or datetime.now(timezone.utc))
        if self.buckets:
            incoming = with_bucket(incoming, self.contract.key, self.buckets)
        incoming = stage(incoming, "add-batch")
        if check:
            self._check(incoming, self.contract.key, "seq")
        incoming, broken = split_contract(incoming, self.contract)
        first = not self.exists()
        if first:  # the first add creates the table (an empty one of the batch's shape)
            table, touched = incoming.drop("seq").limit(0), None
        else:
            table, touched = self._scope(incoming, self.contract.key)
        untied = [self.contract.load_ts] if self.contract.load_ts else []
        result, rejected = change.insert_new(table, incoming, self.contract.key, "seq", untied=untied, staged=True)
        kept = self._keep(rejected.unionByName(broken), "rejected")
        self._replace(result, touched, first=first)
        return kept

    def update(self, patches: DataFrame, key: str | None = None, seq: str = "seq", json_col: str = "json",
               check: bool = False) -> DataFrame:
        """Apply partial updates ``(key, seq, json)``; the key inside the JSON is ignored.

        Returns the patch rows that were not applied: those whose key is not
        in the table, and those of a key whose row would break the contract
        (that row stays as it was). ``check=True`` first refuses a batch that
        repeats a (key, seq) pair.
        """
        self._require()
        patches = stage(patches, "patches")
        if check:
            self._check(patches, key or self.contract.key, seq)
        key = key or self.contract.key
        fields = [f for f in self.fields if f.out != self.contract.key]
        p = patches.withColumnRenamed(key, self.contract.key) if key != self.contract.key else patches
        table, touched = self._scope(p, self.contract.key)
        result, missing = change.patch(table, p, self.contract.key, seq, json_col, fields, list_sep=self.list_sep)
        result, broken = split_contract(result, self.contract)
        broken = stage(broken.select(self.contract.key), "broken")
        if not broken.isEmpty():
            held = table.join(broken, self.contract.key, "left_semi")
            result = result.unionByName(held)
            missing = missing.unionByName(p.join(broken, self.contract.key, "left_semi").select(*missing.columns))
        kept = self._keep(missing, "missing")
        self._replace(result, touched)
        return kept

    def delete(self, keys: DataFrame, key: str | None = None) -> DataFrame:
        """Remove rows by key; returns the requested keys that matched nothing."""
        self._require()
        keys = stage(keys, "delete-keys")
        table, touched = self._scope(keys, key or self.contract.key)
        result, missing = change.delete(table, keys, self.contract.key, key)
        kept = self._keep(missing, "missing")
        self._replace(result, touched)
        return kept

    def apply(self, changes: DataFrame, run_ts: datetime | None = None) -> DataFrame:
        """Apply mixed changes ``(op, seq, <key>, json)`` as if one by one in order of ``seq`` (unique per key).

        ``op``: ``add`` (``json`` holds the record with its key), ``update``
        (``json`` the patch) or ``delete``. For each key only what follows its
        last delete counts, so the batch is one delete, one insert and one
        patch, computed together and published once. Returns the rows that
        took no effect, with ``reason``: ``superseded`` (before a delete of its
        key in the batch), ``key_exists``, ``duplicate_in_batch``,
        ``unknown_key`` (for a delete: not in the stored table), ``unknown_op``, ``null_key``, ``null_seq`` or a broken
        rule of the contract.
        """
        key = self.contract.key
        staged = stage(changes.select("op", "seq", key, "json"), "changes")
        known = F.coalesce(F.col("op").isin("add", "update", "delete"), F.lit(False))
        unusable = F.coalesce(
            F.when(~known, F.lit("unknown_op")), F.when(F.col(key).isNull(), F.lit("null_key")), F.when(F.col("seq").isNull(), F.lit("null_seq"))
        )
        usable = staged.where(unusable.isNull())
        last = usable.where("op = 'delete'").groupBy(key).agg(F.max("seq").alias("__last"))
        dated = stage(split_join(usable, last, key, "left"), "changes-dated")
        after = dated.where(F.col("__last").isNull() | (F.col("seq") > F.col("__last")))

        adds = after.where("op = 'add'").select("seq", F.col(key).alias("__key"), "json")
        parsed = parse_records(adds, "json", self.fields, keep=["seq", "__key"])
        incoming = self._table_shape(parsed.withColumn(key, F.col("__key").cast(parsed.schema[key].dataType)), run_ts or datetime.now(timezone.utc))
        if self.buckets:
            incoming = with_bucket(incoming, key, self.buckets)
        incoming, broken = split_contract(stage(incoming, "add-batch"), self.contract)
        first = not self.exists()
        table, touched = (incoming.drop("seq").limit(0), None) if first else self._scope(usable, key)

        deletes = dated.where("op = 'delete'").select(F.col(key)).distinct()
        base, missing = change.delete(table, deletes, key)
        untied = [self.contract.load_ts] if self.contract.load_ts else []
        added, rejected = change.insert_new(base, incoming, key, "seq", untied=untied, staged=True)

        # a key that was not there takes patches from its first add on
        starts = incoming.join(base.select(key), key, "left_anti").groupBy(key).agg(F.min("seq").alias("__start"))
        updates = split_join(after.where("op = 'update'").drop("__last"), starts, key, "left")
        updates = stage(updates, "updates")
        timely = updates.where(F.col("__start").isNull() | (F.col("seq") > F.col("__start"))).select(key, "seq", "json")
        fields = [f for f in self.fields if f.out != key]
        result, unmatched = change.patch(added, timely, key, "seq", "json", fields, list_sep=self.list_sep)
        good, bad = split_contract(result, self.contract)
        bad = stage(bad.select(key, "reason"), "broken")
        if not bad.isEmpty():  # such a key keeps the row it had before its patches
            good = good.unionByName(added.join(bad, key, "left_semi"))

        def report(df: DataFrame, op: str, reason) -> DataFrame:
            return df.select(F.lit(op).alias("op"), "seq", F.col(key), reason.alias("reason"))

        gone = dated.where("seq < __last")
        none = dated.where("op = 'delete' and seq = __last").join(missing.distinct(), key, "left_semi")
        early = updates.where(F.col("seq") < F.col("__start"))
        outcome = [
            staged.withColumn("reason", unusable).where("reason is not null").select("op", "seq", key, "reason"),
            gone.select("op", "seq", key, F.lit("superseded").alias("reason")),
            report(none, "delete", F.lit("unknown_key")),
            report(rejected, "add", F.col("reason")),
            report(broken, "add", F.col("reason")),
            report(early.select(key, "seq").union(unmatched.select(key, "seq")), "update", F.lit("unknown_key")),
            report(timely.join(bad, key), "update", F.col("reason")),
        ]
        idle = outcome[0]
        for part in outcome[1:]:
            idle = idle.unionByName(part)
        kept = self._keep(idle, "idle")
        self._replace(good, touched, first=first)
        return kept

    def download(self, documents: DataFrame, doc_col: str = "doc", run_ts: datetime | None = None,
                 single: bool = False) -> RefreshResult:
        """Load landed documents (see ``read_documents``): upsert by key, safe rewrite.

        ``single=True`` for one record per document (JSON Lines of objects).
        """
        current = self.raw_table() if self.exists() else None
        done = refresh(self.spark, documents, doc_col, self.fields, self.contract, ParquetSink(self.path),
                       current=current, run_ts=run_ts, buckets=self.buckets, single=single,
                       sort=[self.name_col, self.contract.key] if self.clustered else ())
        if self.clustered:
            clustered.write_fences(self.spark, self.path, [self.name_col], self.contract.key)
        return done
