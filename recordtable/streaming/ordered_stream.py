"""Changes in any order of arrival: keyed state that knows the ``seq`` of what it holds.

Change rows ``(op, seq, <key>, json)`` land in files whose order says nothing;
a late file may hold changes older than those applied before, and files may
be delivered twice. The table becomes what one ordered batch of all rows
(``RecordStore.apply``) gives.

State of a key (a streaming aggregation, RocksDB, so the keys are not bound by memory):

* the greatest ``seq`` of a delete;
* its adds, as a set (which of them counts depends on deletes yet to come);
* for each field the patch of greatest ``seq``.

Every part only grows towards its final value, whatever comes first, so built-in
aggregates keep it: all in the JVM, and the rows of one key are combined in
each task before they meet. A repeated
row changes nothing. The key's row is its first add after the last delete,
with the fields patched after that add; without such an add there is no row.
Rows of the table at the start of the stream count as adds before every ``seq``: they are
copied into the checkpoint when the stream first starts, and read by its first micro-batch.

Each micro-batch hands on one row per changed key,
which ``foreachBatch`` merges into the stored table (only the touched buckets
of a bucketed one). The adds of one key are one row of state, also those before a
delete: a key added millions of times would need another form.

``seq`` is unique per key, as for ``apply``; rows without op, key or ``seq``
and adds that break the contract are left out; a row whose patches break the
contract stays as its add made it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from recordtable.functions.json_rules import has_field, join_list, read_field
from recordtable.operators.contract import apply_defaults, broken_rule, split_contract
from recordtable.plans.commands import RecordStore
from recordtable.session import shared_path
from recordtable.sources.fs import path_exists
from recordtable.sources.layout import with_bucket
from recordtable.sources.sinks import stage

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIRST = -(2**63)  # rows of the table at the start of the stream
COLUMNS = "op string, seq long, json string"


def read_changes(changes: DataFrame, store: RecordStore) -> DataFrame:
    """``key, seq, op, h_<column>..., v_<column>...``: each field of the contract's table, whether it is named and its value."""
    key, fields = store.contract.key, [f for f in store.fields if f.out != store.contract.key]
    usable = F.col("op").isin("add", "update", "delete") & F.col("seq").isNotNull() & F.col(key).isNotNull()
    parsed = changes.where(usable).withColumn("__v", F.try_parse_json("json"))
    v, named, values = F.col("__v"), [], []
    for f in fields:
        value = read_field(v, f)
        value = join_list(value, store.list_sep) if f.kind == "list" else value
        named.append(F.coalesce(has_field(v, f.name), F.lit(False)).alias(f"h_{f.out}"))
        values.append(value.alias(f"v_{f.out}"))
    read = parsed.select(F.col(key).alias("key"), F.col("seq").cast("long").alias("seq"), "op", *named, *values)
    # an add that breaks the contract is no add
    as_rows = read.select("*", *[F.col(f"v_{f.out}").alias(f.out) for f in fields], F.col("key").alias(key))
    return as_rows.where((F.col("op") != "add") | broken_rule(store.contract).isNull()).select(*read.columns)


def copy_at_start(store: RecordStore, read: DataFrame, path: str) -> None:
    """Write the table as it is as ``key, v_<column>...`` of the types of ``read``; without a table, no rows."""
    kept = [f for f in read.schema if f.name == "key" or f.name.startswith("v_")]
    if store.exists():
        named = {f.name: store.contract.key if f.name == "key" else f.name[2:] for f in kept}
        rows = store.table().select(*[F.col(named[f.name]).cast(f.dataType).alias(f.name) for f in kept])
    else:
        rows = store.spark.createDataFrame([], StructType(kept))
    rows.write.mode("overwrite").parquet(path)


def current_rows(read: DataFrame, at_start: str) -> DataFrame:
    """Streaming ``key, present, form, <columns>``: the row of each key that a micro-batch changes.

    ``form``: ``row``, and ``add`` for the row without its patches. ``read``: what :func:`read_changes` gave;
    ``at_start``: the folder of the rows at the start.
    """
    spark, names = read.sparkSession, [c[2:] for c in read.columns if c.startswith("v_")]
    kept = StructType([StructField(f.name, f.dataType) for f in read.schema if f.name == "key" or f.name.startswith("v_")])
    first = spark.readStream.schema(kept).parquet(at_start)
    first = first.select("*", F.lit(FIRST).alias("seq"), F.lit("add").alias("op"), *[F.lit(False).alias(f"h_{c}") for c in names])
    rows = read.withColumn("landed", F.lit(True)).unionByName(first.withColumn("landed", F.lit(False)))

    def last_patch(c: str):
        return F.max(F.when((F.col("op") == "update") & F.col(f"h_{c}"), F.struct("seq", f"v_{c}"))).alias(f"p_{c}")

    state = rows.groupBy("key").agg(
        F.max("landed").alias("landed"),
        F.max(F.when(F.col("op") == "delete", F.col("seq"))).alias("gone"),
        F.collect_set(F.when(F.col("op") == "add", F.struct("seq", *[f"v_{c}" for c in names]))).alias("adds"),
        *[last_patch(c) for c in names],
    )
    counted = F.filter("adds", lambda a: F.col("gone").isNull() | (a["seq"] > F.col("gone")))
    state = state.where("landed").withColumn("start", F.array_min(counted))
    present, own = F.col("start").isNotNull(), {c: F.col(f"start.v_{c}") for c in names}
    held = {c: F.coalesce(F.col(f"p_{c}.seq") > F.col("start.seq"), F.lit(False)) for c in names}
    patched = {c: F.when(held[c], F.col(f"p_{c}.v_{c}")).otherwise(own[c]) for c in names}

    def form(name: str, values: dict):
        return F.struct("key", present.alias("present"), F.lit(name).alias("form"), *[v.alias(c) for c, v in values.items()])

    any_held = F.exists(F.array(F.lit(False), *held.values()), lambda h: h)
    forms = F.when(any_held, F.array(form("row", patched), form("add", own))).otherwise(F.array(form("row", patched)))
    return state.select(F.inline(forms))


def merge_rows(store: RecordStore, rows: DataFrame) -> None:
    """Put what :func:`current_rows` gave into the stored table."""
    key = store.contract.key
    shaped = rows.withColumnRenamed("key", key)
    if not store.exists():
        kept = shaped.drop("present", "form").limit(0)
        empty = apply_defaults(kept, store.contract)
        store._replace(with_bucket(empty, key, store.buckets) if store.buckets else empty, None, first=True)
    types = dict(store.table().dtypes)
    shaped = shaped.withColumn(key, F.col(key).cast(types[key]))
    shaped = stage(with_bucket(shaped, key, store.buckets) if store.buckets else shaped, "ordered-rows")
    table, touched = store._scope(shaped, key)
    good, bad = split_contract(shaped.where("present and form = 'row'"), store.contract)
    held = shaped.where("present and form = 'add'").join(bad.select(key), key, "left_semi")
    new = apply_defaults(good.unionByName(held).drop("present", "form"), store.contract)
    rest = table.join(shaped.select(key).distinct(), key, "left_anti")
    store._replace(rest.unionByName(new.select(*table.columns)), touched)


def start_ordered_stream(
    store: RecordStore,
    landing_dir: str,
    checkpoint_location: str | None = None,
    file_format: str = "json",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Apply the landed ``(op, seq, <key>, json)`` rows to the store, whatever the order of the files.

    The state lives in the stream's checkpoint; a stream that starts anew takes the table as it is. (Checkpoints of
    the state kept by ``transformWithState`` before cannot be continued: start anew.)
    ``state_partitions`` is the number of state stores, fixed when a stream first starts and opened by every
    micro-batch. State grows with the table, not with a batch, so it defaults to the store's buckets
    (without buckets: to ``spark.sql.shuffle.partitions``).
    """
    spark: SparkSession = store.spark
    key_type = dict(store.table().dtypes)[store.contract.key] if store.exists() else "long"
    reader = spark.readStream.format(file_format).schema(f"`{store.contract.key}` {key_type}, {COLUMNS}")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    read = read_changes(reader.load(landing_dir), store)
    checkpoint = checkpoint_location or shared_path(spark, "ordered-stream")
    at_start = f"{checkpoint.rstrip('/')}/rows-at-start"
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):  # it never started
        copy_at_start(store, read, at_start)
    rows = current_rows(read, at_start)
    writer = rows.writeStream.outputMode("update").foreachBatch(lambda batch, _: merge_rows(store, batch))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    settings = {PROVIDER: STATE_STORE}  # on disk: as many keys as the table has
    if state_partitions or store.buckets:
        settings[PARTITIONS] = str(state_partitions or store.buckets)
    before = {name: spark.conf.get(name) for name in settings}
    try:  # a query takes its settings along when it starts
        for name, value in settings.items():
            spark.conf.set(name, value)
        return writer.start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
