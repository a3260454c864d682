"""recordtable: keyed record tables on Spark.

JSON documents -> typed rows with explicit coercion rules, a table contract,
batch insert / upsert / patch / delete as DataFrame operations that return
the rows they could not apply, keyed reads (list, lookup, search, grouped
stats, parameterised SQL) and parquet / JDBC storage with a staged
overwrite. See README.md.
"""

from recordtable.fields import HERO_CONTRACT, HERO_FIELDS, Contract, Field
from recordtable.functions.collations import collated
from recordtable.functions.json_rules import has_field, is_object, join_list, json_int, json_list, json_text, read_field
from recordtable.functions.sql_functions import register_functions
from recordtable.operators.bitmaps import key_bitmaps, where_in_bitmaps
from recordtable.operators.change import delete, fold_patches, insert_new, patch, upsert
from recordtable.operators.contract import apply_defaults, check_batch, check_contract
from recordtable.operators.discover import discover_fields, schema_drift
from recordtable.operators.ingest import explode_documents, map_columns, parse_records, to_documents
from recordtable.operators.joins import bounded_bytes, bounded_rows, split_join
from recordtable.operators.read import count_rows, find, group_stats, key_counts, list_rows, lookup, run_sql
from recordtable.operators.stats import merge_parts, stat_delta, stat_parts, stats_of_parts
from recordtable.plans.commands import RecordStore
from recordtable.plans.refresh import build_batch, refresh
from recordtable.sources.clustered import cluster_table, page, write_fences
from recordtable.sources.layout import bucket_of, overwrite_buckets, touched_buckets, with_bucket, write_bucketed
from recordtable.sources.files import read_documents, read_table
from recordtable.sources.jdbc import read_jdbc
from recordtable.sources.json_array import read_elements
from recordtable.sources.sinks import JdbcSink, ParquetSink, append, overwrite_staged
from recordtable.sources.text_index import find_indexed, index_text, stale_buckets

__all__ = [
    "Contract", "Field", "HERO_CONTRACT", "HERO_FIELDS",
    "collated", "register_functions", "has_field", "is_object", "join_list", "json_int", "json_list", "json_text", "read_field",
    "key_bitmaps", "where_in_bitmaps", "discover_fields", "schema_drift",
    "delete", "fold_patches", "insert_new", "patch", "upsert",
    "apply_defaults", "check_batch", "check_contract",
    "explode_documents", "map_columns", "parse_records", "to_documents",
    "bounded_bytes", "bounded_rows", "split_join",
    "count_rows", "find", "group_stats", "key_counts", "list_rows", "lookup", "run_sql",
    "merge_parts", "stat_delta", "stat_parts", "stats_of_parts",
    "RecordStore", "build_batch", "refresh",
    "bucket_of", "overwrite_buckets", "touched_buckets", "with_bucket", "write_bucketed",
    "cluster_table", "page", "write_fences", "find_indexed", "index_text", "stale_buckets",
    "read_documents", "read_elements", "read_table", "read_jdbc",
    "JdbcSink", "ParquetSink", "append", "overwrite_staged",
]
