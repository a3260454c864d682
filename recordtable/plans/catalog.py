"""Registered queries: one per operator, each over whole driver tables.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame; its
``ORACLE_SQL`` twin computes the same rows in plain SQL (DuckDB dialect)
over the same parquet files. Change sets are derived from whole tables:

* insert / upsert: every order proposes a supplier row for its customer
  (``orders`` joined to ``customer``), ``seq`` = order key. Many orders per
  customer give in-batch duplicates; keys below the supplier count clash.
* patch: every event patches the supplier whose key is its ``user_id``
  with its ``props`` JSON (``k`` -> ``s_acctbal``), ``seq`` = event id.
  User ids beyond the supplier keys are unknown keys.
* delete: orders of every ``MACHINERY`` customer are removed.
* store: supplier rows, then customers added, events as patches, orders' customers deleted;
  refresh_published does the bulk load through a stored table and back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.fields import Contract, Field
from recordtable.functions.json_rules import join_list as join_list_expr
from recordtable.operators.change import delete, insert_new, patch, upsert
from recordtable.operators.contract import apply_defaults, check_batch, check_contract, split_contract
from recordtable.operators.discover import schema_drift
from recordtable.operators.ingest import explode_documents, map_columns, parse_records, to_documents
from recordtable.operators.read import count_rows, find, group_stats, key_counts, list_rows, lookup, run_sql
from recordtable.operators.stats import merge_parts, stat_delta, stat_parts, stats_of_parts
from recordtable.plans.commands import RecordStore
from recordtable.plans.refresh import build_batch
from recordtable.session import ensure_checkpoint_dir, shared_path
from recordtable.sources.clustered import cluster_table, page
from recordtable.sources.files import read_documents, read_table
from recordtable.sources.sinks import ParquetSink, append, overwrite_staged, stage
from recordtable.streaming.ordered_stream import start_ordered_stream

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# --- ingest -----------------------------------------------------------------

PART_FIELDS = (
    Field("p_partkey", "long", default=None),
    Field("p_name", "text"),
    Field("p_type", "text"),
    Field("p_size", "int"),
    Field("p_retailprice", "double"),
    Field("p_words", "list"),
)

SUPPLIER_FIELDS = (
    Field("s_suppkey", "long", default=None),
    Field("s_name", "text"),
    Field("s_nationkey", "int"),
    Field("s_acctbal", "double"),
)


def part_documents(spark: SparkSession, sf_dir: str, with_words: bool = True) -> DataFrame:
    """``part`` rows folded into JSON array documents per brand, at most 256 records each.

    With ``with_words`` each record also carries ``p_words``, the name split
    into a JSON list.
    """
    part = table(spark, sf_dir, "part")
    fields = [f.name for f in PART_FIELDS]
    if with_words:
        part = part.withColumn("p_words", F.split(F.col("p_name"), " "))
    else:
        fields.remove("p_words")
    return to_documents(part, ["p_brand"], fields, "p_partkey", 256)


def q_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents -> records (coercion rules) -> stats per type."""
    records, _ = explode_documents(part_documents(spark, sf_dir, with_words=False), "doc", PART_FIELDS)
    return group_stats(records, "p_type", {"p_size": "avg_size", "p_retailprice": "avg_price"}, "n", digits=4)


def q_parse_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return parse_records(events, "props", [Field("k", "int"), Field("label", "text")], keep=["event_id"])


def mixed_event_json(events: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Each event re-encoded as JSON whose field types depend on its ``event_type``.

    click: ``{"k": 69, "label": "click"}``; view: ``{"k": "69", "label": null}``;
    error: ``{"k": " 69 "}``; purchase: ``{"k": <value, e.g. 6.55>, "label": true}``;
    signup: ``{"k": [69], "label": {"t": "signup"}}``. Every event is kept.
    """
    et = F.col("event_type")
    k = F.get_json_object(F.col("props"), "$.k")
    doc = (
        F.when(et == "click", F.to_json(F.struct(k.cast("int").alias("k"), et.alias("label"))))
        .when(et == "view", F.concat(F.lit('{"k": "'), k, F.lit('", "label": null}')))
        .when(et == "error", F.concat(F.lit('{"k": " '), k, F.lit(' "}')))
        .when(et == "purchase", F.concat(F.lit('{"k": '), F.col("value").cast("string"), F.lit(', "label": true}')))
        .otherwise(F.concat(F.lit('{"k": ['), k, F.lit('], "label": '), F.to_json(F.struct(et.alias("t"))), F.lit("}")))
    )
    return events.select(*keep, doc.alias("doc"))


def q_parse_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The int and text rules over every event, on numbers, numeric and padded strings,
    fractions, arrays, booleans, nulls, objects and absent fields."""
    docs = mixed_event_json(table(spark, sf_dir, "events"))
    return parse_records(docs, "doc", [Field("k", "int"), Field("label", "text")], keep=["event_id"])


def q_explode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    docs = to_documents(supplier, ["s_nationkey"], [f.name for f in SUPPLIER_FIELDS], "s_suppkey", 64)
    records, _ = explode_documents(docs, "doc", SUPPLIER_FIELDS)
    return records.select(*[f.out for f in SUPPLIER_FIELDS])


def supplier_mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier documents per nation (at most 64 elements) where a supplier in debt
    (negative balance) is landed as its bare key number instead of an object."""
    supplier = table(spark, sf_dir, "supplier")
    element = F.when(
        F.col("s_acctbal") >= 0, F.to_json(F.struct(*[F.col(f.name) for f in SUPPLIER_FIELDS]))
    ).otherwise(F.col("s_suppkey").cast("string"))
    chunk = F.expr("s_suppkey div 64")
    return supplier.groupBy("s_nationkey", chunk).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(element), ","), F.lit("]")).alias("doc")
    )


def q_explode_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements that are not objects go to the reject output with their JSON text."""
    _, rejects = explode_documents(supplier_mixed_documents(spark, sf_dir), "doc", SUPPLIER_FIELDS)
    return rejects.select("reason", "value")


def q_map_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return map_columns(part, {"p_partkey": "record_id", "p_name": "record_name", "p_type": "attribute"}, keep=["p_size"])


def q_join_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types of each user as one sorted comma-joined list.

    One aggregation: ``collect_set`` combines inside each task first, so a
    user holding a third of all events sends one set per task (at most the
    distinct types) through the single shuffle.
    """
    events = table(spark, sf_dir, "events")
    return events.groupBy("user_id").agg(
        join_list_expr(F.array_sort(F.collect_set("event_type")), ",").alias("event_types")
    )


PART_LOAD_CONTRACT = Contract(
    key="p_partkey", not_null=("p_partkey",), defaults={"p_size": 0}, max_len={"p_name": 100}, load_ts="loaded_at"
)


def q_refresh_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The refresh pipeline up to the write: documents -> table-shaped rows with defaults.

    The load time is left out of the result (it differs per run).
    """
    batch, _ = build_batch(part_documents(spark, sf_dir), "doc", PART_FIELDS, PART_LOAD_CONTRACT)
    return batch.drop("__seq", "loaded_at")


# --- storage / contract ------------------------------------------------------

def q_read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


PART_CONTRACT = Contract(key="p_partkey", not_null=("p_partkey", "p_name"), max_len={"p_name": 10})


def q_check_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_contract(table(spark, sf_dir, "part"), PART_CONTRACT)


ORDERS_BY_CUSTOMER_CONTRACT = Contract(
    key="o_custkey", not_null=("o_custkey", "o_orderdate"), max_len={"o_orderpriority": 8, "o_orderstatus": 1}
)


def q_check_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract that ``orders`` breaks: its customer key repeats, priorities are too long."""
    return check_contract(table(spark, sf_dir, "orders"), ORDERS_BY_CUSTOMER_CONTRACT)


def q_check_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The patch batch (events by user, ordered by event id) is fit for the per-key pick."""
    return check_batch(supplier_patches(spark, sf_dir), "s_suppkey", "event_id")


# --- reads -------------------------------------------------------------------

def q_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "orders"))


def q_key_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per customer for every customer (0 where none)."""
    return key_counts(table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey")


def q_list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return list_rows(part, ["p_partkey", "p_name", "p_brand", "p_size"], ["p_name"], 50, key="p_partkey")


def q_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup(table(spark, sf_dir, "customer"), "c_custkey", 42)


def q_lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with at least one urgent order."""
    urgent = table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    return lookup(table(spark, sf_dir, "customer"), "c_custkey", keys=urgent, keys_key="o_custkey")


def q_find_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return find(part, "p_name", "old w", cols=["p_partkey", "p_name", "p_size"], key="p_partkey")


def q_find_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "nation"), "n_name", "N_1", key="n_nationkey")


def q_find_ignore_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return find(customer, "c_name", "CUSTOMER#00000004", mode="literal", ignore_case=True,
                cols=["c_custkey", "c_name"], key="c_custkey")


def q_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return group_stats(part, "p_type", {"p_size": "avg_size", "p_retailprice": "avg_price"}, "n", digits=4)


def q_run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        "SELECT p_partkey, p_size FROM part WHERE p_size > :min_size",
        views={"part": table(spark, sf_dir, "part")},
        args={"min_size": 30},
    )


# --- changes -----------------------------------------------------------------

def supplier_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_custkey").alias("s_suppkey"),
        F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"),
        F.col("o_totalprice").alias("s_acctbal"),
        F.col("o_orderkey").alias("seq"),
    )


def q_insert_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = insert_new(table(spark, sf_dir, "supplier"), supplier_proposals(spark, sf_dir), "s_suppkey", "seq")
    return result


def q_insert_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = insert_new(table(spark, sf_dir, "supplier"), supplier_proposals(spark, sf_dir), "s_suppkey", "seq")
    return rejected


def q_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(table(spark, sf_dir, "supplier"), supplier_proposals(spark, sf_dir), "s_suppkey", "seq")[0]


def supplier_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(F.col("user_id").alias("s_suppkey"), "event_id", "props")


PATCH_FIELDS = (Field("k", "int", "s_acctbal"),)


def q_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = patch(table(spark, sf_dir, "supplier"), supplier_patches(spark, sf_dir),
                      "s_suppkey", "event_id", "props", PATCH_FIELDS)
    return result


def q_patch_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, missing = patch(table(spark, sf_dir, "supplier"), supplier_patches(spark, sf_dir),
                       "s_suppkey", "event_id", "props", PATCH_FIELDS)
    return missing


MIXED_PATCH_FIELDS = (Field("k", "int", "s_acctbal"), Field("label", "text", "s_name"))


def q_patch_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field-wise patch fold with mixed encodings: ``label`` absent (error events) keeps the
    name, ``label: null`` (view events) sets it to the default, others set it."""
    patches = mixed_event_json(table(spark, sf_dir, "events"), keep=("user_id", "event_id")).select(
        F.col("user_id").alias("s_suppkey"), "event_id", "doc"
    )
    result, _ = patch(table(spark, sf_dir, "supplier"), patches, "s_suppkey", "event_id", "doc", MIXED_PATCH_FIELDS)
    return result


def machinery_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "MACHINERY")


def q_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    result, _ = delete(table(spark, sf_dir, "orders"), machinery_customers(spark, sf_dir), "o_custkey", "c_custkey")
    return result


def q_delete_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers asked to go by customer key: customers beyond the suppliers match nothing."""
    _, missing = delete(table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer"), "s_suppkey", "c_custkey")
    return missing.select("c_custkey")


# --- rejects, defaults and stored tables --------------------------------------

def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per event: an array of one record, a record that repeats a key beside a
    good one, broken text, a bare number, or an empty array, by event type."""
    events = table(spark, sf_dir, "events")
    et, one = F.col("event_type"), F.concat(F.lit('{"k": '), F.col("event_id").cast("string"), F.lit("}"))
    doc = (
        F.when(et == "click", F.concat(F.lit("["), one, F.lit("]")))
        .when(et == "view", F.concat(F.lit('[{"k": 1, "k": 2}, '), one, F.lit("]")))
        .when(et == "error", F.concat(F.lit("["), one))
        .when(et == "purchase", F.col("event_id").cast("string"))
        .otherwise(F.lit("[]"))
    )
    return events.select("event_id", doc.alias("doc"))


EVENT_DOC_FIELDS = (Field("k", "long", default=None),)


def q_explode_bad_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and rejects of documents of every kind: a bad record costs itself only."""
    records, rejects = explode_documents(landed_documents(spark, sf_dir), "doc", EVENT_DOC_FIELDS, keep=["event_id"])
    records = records.select("event_id", "pos", F.lit("record").alias("reason"), F.col("k").cast("string").alias("value"))
    return records.unionByName(rejects.select("event_id", "pos", "reason", "value"))


def q_contract_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that break a contract, with the first rule they break."""
    _, broken = split_contract(table(spark, sf_dir, "orders"), ORDERS_BY_CUSTOMER_CONTRACT)
    return broken.select("o_orderkey", "reason")


def q_insert_unusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected proposals when odd order keys lose their customer and multiples of four their order key."""
    proposals = supplier_proposals(spark, sf_dir)
    key = F.when(F.col("seq") % 2 == 0, F.col("s_suppkey")).alias("s_suppkey")
    seq = F.when(F.col("seq") % 4 != 0, F.col("seq")).alias("seq")
    proposals = proposals.select(key, "s_name", "s_nationkey", "s_acctbal", seq, F.col("seq").alias("order_key"))
    target = table(spark, sf_dir, "supplier").withColumn("order_key", F.lit(None).cast("long"))
    _, rejected = insert_new(target, proposals, "s_suppkey", "seq")
    return rejected.select("order_key", "s_suppkey", "seq", "reason")


LOAD_TIME = datetime(2024, 1, 2, 3, 4, 5)


def q_apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL discounts and missing sizes filled, and every row stamped with one load time."""
    part = table(spark, sf_dir, "part").withColumn("p_size", F.when(F.col("p_size") > 10, F.col("p_size")))
    out = apply_defaults(part, PART_LOAD_CONTRACT, LOAD_TIME)
    return out.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


LIST_PATCH_FIELDS = (Field("tags", "list", "p_name"),)


def q_patch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event patches the part of its event id with a list of its type and user; the list is stored joined."""
    events = table(spark, sf_dir, "events")
    tags = F.to_json(F.struct(F.array(F.col("event_type"), F.col("user_id").cast("string")).alias("tags")))
    patches = events.select(F.col("event_id").alias("p_partkey"), F.col("event_id").alias("seq"), tags.alias("doc"))
    result, _ = patch(table(spark, sf_dir, "part"), patches, "p_partkey", "seq", "doc", LIST_PATCH_FIELDS)
    return result


def q_append_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written, appended once more, then overwritten by a plan that reads the table itself."""
    customer = table(spark, sf_dir, "customer")
    ensure_checkpoint_dir(spark)
    sink = ParquetSink(shared_path(spark, "customers"))
    append(customer, sink, mode="error")
    append(customer, sink)
    twice = spark.read.parquet(sink.path)
    overwrite_staged(spark, twice.groupBy(*customer.columns).agg(F.count(F.lit(1)).alias("copies")), sink)
    return spark.read.parquet(sink.path)


STORE_FIELDS = (
    Field("s_suppkey", "long", default=None),
    Field("s_name", "text"),
    Field("s_nationkey", "int"),
    Field("s_acctbal", "double"),
)
STORE_CONTRACT = Contract(key="s_suppkey", not_null=("s_suppkey",), max_len={"s_name": 100})


def stored_suppliers(spark: SparkSession, sf_dir: str, buckets: int | None) -> DataFrame:
    """A store filled from ``supplier``, then add (customers), update (events) and delete (orders' customers)."""
    ensure_checkpoint_dir(spark)
    store = RecordStore(spark, shared_path(spark, "suppliers"), STORE_FIELDS, STORE_CONTRACT, buckets=buckets)
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    fields = [f.name for f in STORE_FIELDS]
    store.add(supplier.select(F.col("s_suppkey").alias("seq"), F.to_json(F.struct(*fields)).alias("json")))
    as_supplier = [F.col(f"c_{n}").alias(f"s_{m}") for n, m in
                   (("custkey", "suppkey"), ("name", "name"), ("nationkey", "nationkey"), ("acctbal", "acctbal"))]
    store.add(customer.select(F.col("c_custkey").alias("seq"), F.to_json(F.struct(*as_supplier)).alias("json")))
    events = table(spark, sf_dir, "events")
    patched = F.to_json(F.struct(F.col("event_type").alias("s_name")))
    store.update(events.select(F.col("user_id").alias("s_suppkey"), F.col("event_id").alias("seq"), patched.alias("json")))
    store.delete(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("s_suppkey")))
    return store.table()


def q_store_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_suppliers(spark, sf_dir, None)


def q_refresh_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bulk loads into one bucketed table, published and read back: suppliers, then customers that replace by key."""
    ensure_checkpoint_dir(spark)
    store = RecordStore(spark, shared_path(spark, "loaded"), STORE_FIELDS, STORE_CONTRACT, buckets=8)
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    as_supplier = [F.col(f"c_{n}").alias(f"s_{n if n != 'custkey' else 'suppkey'}") for n in ("custkey", "name", "nationkey", "acctbal")]
    store.download(to_documents(supplier, ["s_nationkey"], [f.name for f in STORE_FIELDS], "s_suppkey", 50), "doc")
    richer = customer.where("c_acctbal > 0").select(*as_supplier)
    store.download(to_documents(richer, ["s_nationkey"], [f.name for f in STORE_FIELDS], "s_suppkey", 50), "doc")
    return store.table()


def q_store_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_suppliers(spark, sf_dir, 8)


SEGMENT_AVGS = {"c_acctbal": "avg_balance", "c_nationkey": "avg_nation"}
SEGMENT_FIELDS = (Field("s", "text", "c_mktsegment"), Field("b", "double", "c_acctbal"))


def q_group_stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer statistics by segment, kept while urgent orders delete customers, suppliers are added and events patch."""
    ensure_checkpoint_dir(spark)
    customer, supplier, events = (table(spark, sf_dir, t) for t in ("customer", "supplier", "events"))
    key, by = "c_custkey", "c_mktsegment"
    parts = stage(stat_parts(customer, by, SEGMENT_AVGS), "stat-parts")

    gone = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias(key))
    new = supplier.select((F.lit(-1) - F.col("s_suppkey")).alias(key), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"),
                          F.col("s_acctbal").alias("c_acctbal"), F.lit("SUPPLIER").alias(by), F.col("s_suppkey").alias("seq"))
    doc = F.to_json(F.struct(F.when(F.col("event_type") == "signup", F.lit("MOVED")).alias("s"), F.col("value").alias("b")))
    patches = events.select(F.col("user_id").alias(key), F.col("event_id").alias("seq"), doc.alias("doc"))
    named = gone.union(new.select(key)).union(patches.select(key))
    touched = stage(lookup(customer, key, keys=named), "stat-touched")  # all that is read of the table
    left, _ = delete(touched, gone, key)
    more, _ = insert_new(left, new, key, "seq")
    after, _ = patch(more, patches, key, "seq", "doc", SEGMENT_FIELDS)
    parts = merge_parts(parts, stat_delta(touched, after, by, SEGMENT_AVGS), by)
    rounded = [F.round(c, 4).alias(c) for c in SEGMENT_AVGS.values()]
    return stats_of_parts(parts, by, SEGMENT_AVGS, "customers").select(by, "customers", *rounded)


def landed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(op, seq, s_suppkey, json)``: supplier and customer records, events as patches, urgent orders as deletes."""
    supplier, customer, events, orders = (table(spark, sf_dir, t) for t in ("supplier", "customer", "events", "orders"))

    def row(df: DataFrame, op: str, seq: str, key: str, **doc: str) -> DataFrame:
        fields = [F.expr(v).alias(f"s_{c}") for c, v in doc.items()]
        doc_json = F.to_json(F.struct(*fields)) if fields else F.lit(None).cast("string")
        return df.select(F.lit(op).alias("op"), F.expr(seq).cast("long").alias("seq"), F.col(key).alias("s_suppkey"), doc_json.alias("json"))

    adds = row(supplier, "add", "10", "s_suppkey", suppkey="s_suppkey", name="s_name", nationkey="s_nationkey", acctbal="s_acctbal")
    late = row(customer, "add", "15 * c_custkey + 102", "c_custkey", suppkey="c_custkey", name="c_name", nationkey="c_nationkey", acctbal="c_acctbal")
    patches = row(events, "update", "3 * event_id + 100", "user_id", name="event_type", acctbal="if(event_type = 'purchase', value, null)")
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    deletes = row(urgent, "delete", "3 * o_orderkey + 101", "o_custkey")
    return adds.unionByName(late).unionByName(patches).unionByName(deletes)


def q_ordered_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes landed twice, in files without order, and streamed into a store by three micro-batches."""
    ensure_checkpoint_dir(spark)
    landed = shared_path(spark, "landed")
    scattered = landed_changes(spark, sf_dir).repartition(6, F.xxhash64("seq", "op"))
    scattered.write.json(landed)
    scattered.write.mode("append").json(landed)
    store = RecordStore(spark, shared_path(spark, "ordered"), STORE_FIELDS, STORE_CONTRACT, buckets=8)
    start_ordered_stream(store, landed, max_files_per_trigger=4).awaitTermination()
    return store.table()


ARRAY_FIELDS = (Field("o_orderkey", "long", default=None), Field("note", "text"), Field("marks", "list"))
ORDERS_A_FILE = 100_000


def q_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as files of one JSON array each, read back by byte ranges.

    The notes hold commas, brackets, quotes and backslashes; each array ends with a bare number, which is no record.
    """
    orders = table(spark, sf_dir, "orders")
    note = F.concat(F.lit('a "'), "o_orderpriority", F.lit('", ['), "o_orderstatus", F.lit(" {\\"))
    record = F.struct("o_orderkey", note.alias("note"), F.array("o_orderstatus", "o_orderpriority").alias("marks"))
    number = F.expr(f"o_orderkey div {ORDERS_A_FILE}").alias("number")
    records = orders.select(number, F.lit(1).alias("place"), F.concat(F.to_json(record), F.lit(",")).alias("line"))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("place"), F.lit("[").alias("line")), F.struct(F.lit(2).alias("place"), F.lit("0]").alias("line"))))
    lines = records.unionByName(orders.select(number).distinct().select("number", ends.alias("e")).select("number", "e.*"))
    ensure_checkpoint_dir(spark)
    landed = shared_path(spark, "arrays")
    lines.repartition("number").sortWithinPartitions("number", "place").select("number", "line").write.partitionBy("number").text(landed)
    documents = read_documents(spark, f"{landed}/*", layout="array")
    records, _ = explode_documents(documents, "doc", ARRAY_FIELDS, single=True)
    return records.select("o_orderkey", "note", join_list_expr("marks").alias("marks"))


DRIFT_FIELDS = (Field("k", "int"), Field("label", "text"), Field("stamp", "long"))


def q_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the events' documents by event type, against declared ones: numbers landed as text, lists, nulls and objects,
    a field that no document holds and, in every second document, one that is not declared."""
    docs = mixed_event_json(table(spark, sf_dir, "events"), keep=("event_id", "event_type"))
    extra = F.regexp_replace("doc", r"\}$", ', "extra": {"id": 1}}')
    docs = docs.select(F.col("event_type").alias("kind"), F.when(F.col("event_id") % 2 == 0, extra).otherwise(F.col("doc")).alias("doc"))
    return schema_drift(docs, "doc", "kind", DRIFT_FIELDS)


NAME_STORE_FIELDS = (Field("p_partkey", "long", default=None), Field("p_name", "text"), Field("p_size", "int"))
NAME_STORE_CONTRACT = Contract(key="p_partkey", not_null=("p_partkey",), max_len={"p_name": 100})


def q_find_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts in a bucketed table with a trigram index on the name. Some get a nation's name and the index is brought up to date,
    some a region's and it is not; then a pattern with wildcards, one that only new names match and one without a trigram."""
    ensure_checkpoint_dir(spark)
    store = RecordStore(spark, shared_path(spark, "named"), NAME_STORE_FIELDS, NAME_STORE_CONTRACT, name_col="p_name",
                        find_cols=("p_partkey", "p_name", "p_size"), buckets=32)
    part, nation, region = (table(spark, sf_dir, t) for t in ("part", "nation", "region"))
    record = F.to_json(F.struct(*[f.name for f in NAME_STORE_FIELDS]))
    store.add(part.select(F.col("p_partkey").alias("seq"), record.alias("json")))
    store.index_names()
    for names, key, name in ((nation, "n_nationkey", "n_name"), (region, "r_regionkey", "r_name")):
        patch_doc = F.to_json(F.struct(F.col(name).alias("p_name")))
        store.update(names.select((F.col(key) * 3 + 1).alias("p_partkey"), F.col(key).alias("seq"), patch_doc.alias("json")))
        if names is nation:
            store.index_names()
    found = None
    for pattern in ("ld w%dge", "ION_1", "AS", "ot"):
        rows = store.find(pattern).withColumn("pattern", F.lit(pattern))
        found = rows if found is None else found.unionByName(rows)
    return found


PAGE_ROWS = 500


def q_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept in the order of (customer, order key), urgent ones without a customer; three pages, each behind the last row of the one before."""
    ensure_checkpoint_dir(spark)
    path, order = shared_path(spark, "clustered"), ["customer"]
    orders = table(spark, sf_dir, "orders").withColumn("customer", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")))
    cluster_table(spark, orders.select("o_orderkey", "customer", "o_totalprice"), path, order, "o_orderkey")
    pages, after = None, None
    for number in range(3):
        rows = stage(page(spark, path, ["customer", "o_orderkey", "o_totalprice"], order, "o_orderkey", PAGE_ROWS, after), "page")
        last = rows.agg(F.max(F.struct("customer", "o_orderkey"))).first()[0]  # the cursor: nulls are least
        after = tuple(last) if last is not None else after
        rows = rows.withColumn("page", F.lit(number))
        pages = rows if pages is None else pages.unionByName(rows)
    return pages


def dressed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose names are in capitals, accented or as they were, by size."""
    name = F.col("p_name")
    dressed = F.when(F.col("p_size") % 3 == 0, F.upper(name)).when(F.col("p_size") % 3 == 1, F.translate(name, "aeiou", "àéíöû")).otherwise(name)
    return table(spark, sf_dir, "part").withColumn("p_name", dressed)


def q_find_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that contain two parts whatever their case and accents."""
    return find(dressed_parts(spark, sf_dir), "p_name", "ÓLD%Ge", cols=["p_partkey", "p_name"], key="p_partkey", collation="UNICODE_CI_AI")


def q_list_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = dressed_parts(spark, sf_dir)
    return list_rows(parts, ["p_partkey", "p_name"], ["p_name"], 50, key="p_partkey", collation="UNICODE_CI_AI")


def q_stats_collated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_stats(dressed_parts(spark, sf_dir), "p_name", {"p_size": "avg_size"}, "n", digits=4, collation="UNICODE_CI_AI")


def q_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship as one SQL text: documents exploded, coerced and grouped."""
    return run_sql(
        spark,
        """
        SELECT p_type, count(*) AS n, round(avg(p_size), :digits) AS avg_size, round(avg(p_retailprice), :digits) AS avg_price
        FROM (
          SELECT json_text(element, 'p_type') AS p_type, json_int(element, 'p_size') AS p_size, json_double(element, 'p_retailprice') AS p_retailprice
          FROM documents_of_parts, LATERAL json_elements(doc)
        )
        GROUP BY p_type ORDER BY n DESC, p_type NULLS FIRST""",
        views={"documents_of_parts": part_documents(spark, sf_dir, with_words=False)},
        args={"digits": 4},
        functions=True,
    )


def q_sql_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and rejects of documents of every kind, in SQL."""
    return run_sql(
        spark,
        """
        SELECT event_id, pos, 'record' AS reason, cast(json_long(element, 'k', null) AS string) AS value FROM landed, LATERAL json_elements(doc)
        UNION ALL SELECT event_id, pos, reason, value FROM landed, LATERAL json_rejects(doc)""",
        views={"landed": landed_documents(spark, sf_dir)},
        functions=True,
    )


QUERIES: dict[str, Query] = {
    "flagship_stats": q_flagship,
    "parse_records": q_parse_records,
    "parse_coercion": q_parse_coercion,
    "explode_documents": q_explode_documents,
    "explode_rejects": q_explode_rejects,
    "map_columns": q_map_columns,
    "join_list": q_join_list,
    "refresh_batch": q_refresh_batch,
    "read_table": q_read_table,
    "check_contract": q_check_contract,
    "check_contract_violations": q_check_contract_violations,
    "check_batch": q_check_batch,
    "count_rows": q_count_rows,
    "key_counts": q_key_counts,
    "list_rows": q_list_rows,
    "lookup": q_lookup,
    "lookup_keys": q_lookup_keys,
    "find_like": q_find_like,
    "find_wildcard": q_find_wildcard,
    "find_ignore_case": q_find_ignore_case,
    "group_stats": q_group_stats,
    "run_sql": q_run_sql,
    "insert_new": q_insert_new,
    "insert_rejected": q_insert_rejected,
    "upsert": q_upsert,
    "patch": q_patch,
    "patch_missing": q_patch_missing,
    "patch_mixed": q_patch_mixed,
    "delete": q_delete,
    "delete_missing": q_delete_missing,
    "explode_bad_documents": q_explode_bad_documents,
    "contract_rejects": q_contract_rejects,
    "insert_unusable": q_insert_unusable,
    "apply_defaults": q_apply_defaults,
    "patch_list": q_patch_list,
    "append_overwrite": q_append_overwrite,
    "store_flat": q_store_flat,
    "store_bucketed": q_store_bucketed,
    "refresh_published": q_refresh_published,
    "ordered_changes": q_ordered_changes,
    "group_stats_incremental": q_group_stats_incremental,
    "array_files": q_array_files,
    "schema_drift": q_schema_drift,
    "find_indexed": q_find_indexed,
    "list_pages": q_list_pages,
    "find_collated": q_find_collated,
    "list_collated": q_list_collated,
    "stats_collated": q_stats_collated,
    "sql_functions": q_sql_functions,
    "sql_rejects": q_sql_rejects,
}


_PROPOSALS = """
inc AS (
  SELECT o.o_custkey AS s_suppkey, c.c_name AS s_name, c.c_nationkey AS s_nationkey,
         o.o_totalprice AS s_acctbal, o.o_orderkey AS seq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)"""

_STATS = """
SELECT p_type, count(*) AS n, round(avg(p_size), 4) AS avg_size, round(avg(p_retailprice), 4) AS avg_price
FROM part GROUP BY p_type"""

_STORE = """
WITH added AS (
  SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
  WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)
),
last AS (SELECT user_id, arg_max(event_type, event_id) AS name FROM events GROUP BY user_id)
SELECT s_suppkey, coalesce(l.name, s_name) AS s_name, s_nationkey, s_acctbal
FROM added LEFT JOIN last l ON l.user_id = s_suppkey
WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders)"""

_BAD_DOCUMENTS = """
SELECT event_id, CASE WHEN event_type = 'click' THEN 0 ELSE 1 END AS pos, 'record' AS reason,
       CAST(event_id AS VARCHAR) AS value
FROM events WHERE event_type IN ('click', 'view')
UNION ALL
SELECT event_id, 0, 'unparsable_element', '{"k":1,"k":2}' FROM events WHERE event_type = 'view'
UNION ALL
SELECT event_id, NULL, 'unparsable', '[{"k": ' || event_id || '}' FROM events WHERE event_type = 'error'
UNION ALL
SELECT event_id, NULL, 'scalar_root', CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'purchase'"""

_DRESSED = """
WITH dressed AS (
  SELECT p_partkey, p_size, CASE p_size % 3 WHEN 0 THEN upper(p_name) WHEN 1 THEN translate(p_name, 'aeiou', 'àéíöû') ELSE p_name END AS p_name
  FROM part
)"""

ORACLE_SQL: dict[str, str] = {
    "find_indexed": """
WITH named AS (
  SELECT p_partkey, coalesce(r_name, n_name, p_name) AS p_name, p_size
  FROM part LEFT JOIN nation ON n_nationkey * 3 + 1 = p_partkey LEFT JOIN region ON r_regionkey * 3 + 1 = p_partkey
)
SELECT named.*, pattern FROM named, (VALUES ('ld w%dge'), ('ION_1'), ('AS'), ('ot')) v(pattern) WHERE p_name LIKE '%' || pattern || '%'""",
    "list_pages": f"""
WITH placed AS (
  SELECT CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS customer, o_orderkey, o_totalprice,
         row_number() OVER (ORDER BY customer NULLS FIRST, o_orderkey) - 1 AS place
  FROM orders
)
SELECT customer, o_orderkey, o_totalprice, CAST(place // {PAGE_ROWS} AS INTEGER) AS page FROM placed WHERE place < {3 * PAGE_ROWS}""",
    "find_collated": f"""{_DRESSED}
SELECT p_partkey, p_name FROM dressed WHERE lower(strip_accents(p_name)) LIKE '%old%ge%'""",
    "list_collated": f"""{_DRESSED}
SELECT p_partkey, p_name FROM dressed ORDER BY lower(strip_accents(p_name)) NULLS FIRST, p_partkey LIMIT 50""",
    "stats_collated": f"""{_DRESSED}
SELECT min(p_name) AS p_name, count(*) AS n, round(avg(p_size), 4) AS avg_size FROM dressed GROUP BY lower(strip_accents(p_name))""",
    "sql_functions": _STATS,
    "sql_rejects": _BAD_DOCUMENTS,
    "flagship_stats": _STATS,
    "parse_records": """
SELECT event_id,
       coalesce(try_cast(json_extract_string(props, '$.k') AS INTEGER), 0) AS k,
       coalesce(json_extract_string(props, '$.label'), '') AS label
FROM events""",
    "parse_coercion": """
SELECT event_id,
       CASE event_type
         WHEN 'purchase' THEN CAST(trunc(value) AS INTEGER)
         WHEN 'signup' THEN 0
         ELSE CAST(json_extract_string(props, '$.k') AS INTEGER)
       END AS k,
       CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'true' ELSE '' END AS label
FROM events""",
    "explode_documents": "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
    "explode_rejects": """
SELECT 'not_an_object' AS reason, CAST(s_suppkey AS VARCHAR) AS value FROM supplier WHERE s_acctbal < 0""",
    "map_columns": "SELECT p_partkey AS record_id, p_name AS record_name, p_type AS attribute, p_size FROM part",
    "join_list": """
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
FROM events GROUP BY user_id""",
    "refresh_batch": """
SELECT p_partkey, p_name, p_type, p_size, p_retailprice,
       array_to_string(string_split(p_name, ' '), ',') AS p_words
FROM part""",
    "read_table": "SELECT * FROM customer",
    "check_contract": """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE p_partkey IS NULL) AS null_key,
       count(p_partkey) - count(DISTINCT p_partkey) AS duplicate_key,
       count(*) FILTER (WHERE p_name IS NULL) AS null_p_name,
       count(*) FILTER (WHERE length(p_name) > 10) AS too_long_p_name
FROM part""",
    "check_contract_violations": """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE o_custkey IS NULL) AS null_key,
       count(o_custkey) - count(DISTINCT o_custkey) AS duplicate_key,
       count(*) FILTER (WHERE o_orderdate IS NULL) AS null_o_orderdate,
       count(*) FILTER (WHERE length(o_orderpriority) > 8) AS too_long_o_orderpriority,
       count(*) FILTER (WHERE length(o_orderstatus) > 1) AS too_long_o_orderstatus
FROM orders""",
    "check_batch": """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE user_id IS NULL) AS null_key,
       count(*) FILTER (WHERE event_id IS NULL) AS null_seq,
       count(*) FILTER (WHERE user_id IS NOT NULL AND event_id IS NOT NULL)
         - count(DISTINCT (user_id, event_id)) FILTER (WHERE user_id IS NOT NULL AND event_id IS NOT NULL)
         AS duplicate_key_seq
FROM events""",
    "count_rows": "SELECT count(*) AS rows FROM orders",
    "key_counts": """
SELECT c.c_custkey, count(o.o_orderkey) AS n
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey
GROUP BY c.c_custkey""",
    "list_rows": """
SELECT p_partkey, p_name, p_brand, p_size FROM part
ORDER BY p_name NULLS FIRST, p_partkey LIMIT 50""",
    "lookup": "SELECT * FROM customer WHERE c_custkey = 42",
    "lookup_keys": """
SELECT * FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "find_like": "SELECT p_partkey, p_name, p_size FROM part WHERE p_name LIKE '%old w%'",
    "find_wildcard": "SELECT * FROM nation WHERE n_name LIKE '%N_1%'",
    "find_ignore_case": "SELECT c_custkey, c_name FROM customer WHERE c_name ILIKE '%CUSTOMER#00000004%'",
    "group_stats": _STATS,
    "run_sql": "SELECT p_partkey, p_size FROM part WHERE p_size > 30",
    "insert_new": f"""
WITH {_PROPOSALS},
first AS (SELECT s_suppkey, min(seq) AS seq FROM inc GROUP BY s_suppkey)
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL
SELECT i.s_suppkey, i.s_name, i.s_nationkey, i.s_acctbal
FROM inc i JOIN first f ON i.s_suppkey = f.s_suppkey AND i.seq = f.seq
WHERE i.s_suppkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "insert_rejected": f"""
WITH {_PROPOSALS},
first AS (SELECT s_suppkey, min(seq) AS seq FROM inc GROUP BY s_suppkey)
SELECT i.s_suppkey, i.s_name, i.s_nationkey, i.s_acctbal, i.seq,
       CASE WHEN i.seq <> f.seq THEN 'duplicate_in_batch' ELSE 'key_exists' END AS reason
FROM inc i JOIN first f ON i.s_suppkey = f.s_suppkey
WHERE i.seq <> f.seq OR i.s_suppkey IN (SELECT s_suppkey FROM supplier)""",
    "upsert": f"""
WITH {_PROPOSALS},
last AS (SELECT s_suppkey, max(seq) AS seq FROM inc GROUP BY s_suppkey)
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
WHERE s_suppkey NOT IN (SELECT s_suppkey FROM inc)
UNION ALL
SELECT i.s_suppkey, i.s_name, i.s_nationkey, i.s_acctbal
FROM inc i JOIN last l ON i.s_suppkey = l.s_suppkey AND i.seq = l.seq""",
    "patch": """
WITH p AS (
  SELECT user_id AS s_suppkey,
         arg_max(coalesce(try_cast(json_extract_string(props, '$.k') AS INTEGER), 0), event_id) AS k
  FROM events WHERE json_exists(props, '$.k') GROUP BY user_id
)
SELECT s.s_suppkey, s.s_name, s.s_nationkey,
       CASE WHEN p.s_suppkey IS NULL THEN s.s_acctbal ELSE CAST(p.k AS DOUBLE) END AS s_acctbal
FROM supplier s LEFT JOIN p ON s.s_suppkey = p.s_suppkey""",
    "patch_missing": """
SELECT user_id AS s_suppkey, event_id, props FROM events
WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)""",
    "patch_mixed": """
WITH e AS (
  SELECT user_id AS s_suppkey, event_id,
         CASE event_type
           WHEN 'purchase' THEN CAST(trunc(value) AS INTEGER)
           WHEN 'signup' THEN 0
           ELSE CAST(json_extract_string(props, '$.k') AS INTEGER)
         END AS k,
         event_type <> 'error' AS has_label,
         CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'true' ELSE '' END AS label
  FROM events
),
p AS (
  SELECT s_suppkey, arg_max(k, event_id) AS k,
         arg_max(label, event_id) FILTER (WHERE has_label) AS label,
         bool_or(has_label) AS any_label
  FROM e GROUP BY s_suppkey
)
SELECT s.s_suppkey,
       CASE WHEN p.any_label THEN p.label ELSE s.s_name END AS s_name,
       s.s_nationkey,
       CASE WHEN p.s_suppkey IS NULL THEN s.s_acctbal ELSE CAST(p.k AS DOUBLE) END AS s_acctbal
FROM supplier s LEFT JOIN p ON s.s_suppkey = p.s_suppkey""",
    "delete": """
SELECT * FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""",
    "delete_missing": """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "explode_bad_documents": _BAD_DOCUMENTS,
    "contract_rejects": """
SELECT o_orderkey,
       CASE WHEN o_custkey IS NULL THEN 'null_key' WHEN o_orderdate IS NULL THEN 'null_o_orderdate'
            WHEN length(o_orderpriority) > 8 THEN 'too_long_o_orderpriority' ELSE 'too_long_o_orderstatus' END AS reason
FROM orders
WHERE o_custkey IS NULL OR o_orderdate IS NULL OR length(o_orderpriority) > 8 OR length(o_orderstatus) > 1""",
    "insert_unusable": f"""
WITH {_PROPOSALS},
odd AS (
  SELECT CASE WHEN seq % 2 = 0 THEN s_suppkey END AS s_suppkey, CASE WHEN seq % 4 <> 0 THEN seq END AS seq,
         seq AS order_key
  FROM inc
),
first AS (
  SELECT s_suppkey, min(seq) AS seq FROM odd WHERE s_suppkey IS NOT NULL AND seq IS NOT NULL GROUP BY s_suppkey
)
SELECT o.order_key, o.s_suppkey, o.seq,
       CASE WHEN o.s_suppkey IS NULL THEN 'null_key' WHEN o.seq IS NULL THEN 'null_seq'
            WHEN o.seq <> f.seq THEN 'duplicate_in_batch' ELSE 'key_exists' END AS reason
FROM odd o LEFT JOIN first f ON o.s_suppkey = f.s_suppkey
WHERE o.s_suppkey IS NULL OR o.seq IS NULL OR o.seq <> f.seq OR o.s_suppkey IN (SELECT s_suppkey FROM supplier)""",
    "apply_defaults": """
SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS p_size, p_retailprice,
       '2024-01-02 03:04:05' AS loaded_at
FROM part""",
    "patch_list": """
SELECT p_partkey,
       CASE WHEN e.event_id IS NULL THEN p_name ELSE e.event_type || coalesce(',' || e.user_id, '') END AS p_name,
       p_brand, p_type, p_size, p_retailprice
FROM part LEFT JOIN events e ON e.event_id = p_partkey""",
    "append_overwrite": "SELECT *, CAST(2 AS BIGINT) AS copies FROM customer",
    "store_flat": _STORE,
    "store_bucketed": _STORE,
    "group_stats_incremental": """
WITH kept AS (
  SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer
  WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
  UNION ALL
  SELECT -1 - s_suppkey, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier
),
last AS (
  SELECT user_id, arg_max(value, event_id) AS balance, max(event_id) FILTER (event_type = 'signup') AS moved FROM events GROUP BY user_id
),
patched AS (
  SELECT c_nationkey, coalesce(balance, c_acctbal) AS c_acctbal, CASE WHEN moved IS NULL THEN c_mktsegment ELSE 'MOVED' END AS c_mktsegment
  FROM kept LEFT JOIN last ON user_id = c_custkey
)
SELECT c_mktsegment, count(*) AS customers, round(avg(c_acctbal), 4) AS avg_balance, round(avg(c_nationkey), 4) AS avg_nation
FROM patched GROUP BY c_mktsegment""",
    "ordered_changes": """
WITH adds AS (
  SELECT s_suppkey AS k, 10 AS seq, s_name, s_nationkey, s_acctbal FROM supplier
  UNION ALL
  SELECT c_custkey, 15 * c_custkey + 102, c_name, c_nationkey, c_acctbal FROM customer
),
gone AS (SELECT o_custkey AS k, max(3 * o_orderkey + 101) AS seq FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey),
first AS (
  SELECT k, min(a.seq) AS seq, arg_min(s_name, a.seq) AS s_name, arg_min(s_nationkey, a.seq) AS s_nationkey, arg_min(s_acctbal, a.seq) AS s_acctbal
  FROM adds a LEFT JOIN gone g USING (k) WHERE g.seq IS NULL OR a.seq > g.seq GROUP BY k
),
patched AS (
  SELECT k, arg_max(event_type, event_id) AS name, arg_max(value, event_id) FILTER (event_type = 'purchase') AS balance
  FROM first JOIN events ON user_id = k AND 3 * event_id + 100 > seq GROUP BY k
)
SELECT k AS s_suppkey, coalesce(name, s_name) AS s_name, s_nationkey, coalesce(balance, s_acctbal) AS s_acctbal
FROM first LEFT JOIN patched USING (k)""",
    "schema_drift": """
WITH d AS (
  SELECT event_type AS source, event_id,
         CASE event_type
           WHEN 'click' THEN json_object('k', 1, 'label', 'click')
           WHEN 'view' THEN json_object('k', '1', 'label', NULL)
           WHEN 'error' THEN json_object('k', ' 1 ')
           WHEN 'purchase' THEN json_object('k', value, 'label', true)
           ELSE json_object('k', [1], 'label', json_object('t', event_type))
         END AS doc
  FROM events
),
each AS (
  SELECT source, unnest(json_keys(doc)) AS field, doc FROM d
  UNION ALL SELECT source, 'extra', '{"extra": {}}' FROM d WHERE event_id % 2 = 0
),
found AS (
  SELECT source, field, count(*) AS n,
         max(CASE json_type(doc, '$.' || field) WHEN 'UBIGINT' THEN 'whole' WHEN 'BIGINT' THEN 'whole' WHEN 'DOUBLE' THEN 'fraction'
             WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'object' ELSE 'null' END) AS seen
  FROM each GROUP BY source, field
),
declared AS (SELECT * FROM (VALUES ('k', 'int'), ('label', 'text'), ('stamp', 'long')) v(field, declared)),
documents AS (SELECT source, count(*) AS documents FROM d GROUP BY source),
wanted AS (SELECT source, field FROM found UNION SELECT source, field FROM documents CROSS JOIN declared)
SELECT source, field,
       CASE WHEN declared IS NULL THEN 'new' WHEN n IS NULL THEN 'missing' WHEN seen = 'null' THEN 'null_only'
            WHEN (declared, seen) IN (('int', 'whole'), ('text', 'text')) THEN 'as_declared' ELSE 'retyped' END AS status,
       declared, seen, coalesce(n, 0) AS n, documents
FROM wanted JOIN documents USING (source) LEFT JOIN found USING (source, field) LEFT JOIN declared USING (field)""",
    "array_files": """
SELECT o_orderkey, 'a "' || o_orderpriority || '", [' || o_orderstatus || ' {\\' AS note, o_orderstatus || ',' || o_orderpriority AS marks
FROM orders""",
    "refresh_published": """
SELECT c_custkey AS s_suppkey, c_name AS s_name, c_nationkey AS s_nationkey, c_acctbal AS s_acctbal FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
}
