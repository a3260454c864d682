"""Schema discovery: which fields landed documents hold, and how they differ from the declared ones.

Types are those of Spark's ``schema_of_variant_agg``, taken per source and
field, and compared as families, since a whole number that grows a digit is no drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.fields import Field
from recordtable.functions.json_rules import is_object

#: Families of values that a field's kind takes without loss; a null fits every kind.
FITS = {
    "int": ("whole",),
    "long": ("whole",),
    "double": ("whole", "fraction"),
    "text": ("text",),
    "list": ("list",),
}


def _family(schema: Column) -> Column:
    """Family of a variant schema: null, whole, fraction, text, boolean, list, object, time, or mixed."""
    return (
        F.when(schema == "VOID", "null")
        .when(schema == "BIGINT", "whole")
        .when((schema == "DOUBLE") | (schema == "FLOAT") | schema.startswith("DECIMAL"), "fraction")
        .when(schema == "STRING", "text")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema.startswith("ARRAY"), "list")
        .when(schema.startswith("OBJECT"), "object")
        .when(schema.startswith("TIMESTAMP") | (schema == "DATE"), "time")
        .otherwise("mixed")
    )


def discover_fields(df: DataFrame, json_col: str, source: str) -> DataFrame:
    """Top-level fields of the JSON objects of each source -> ``(source, field, seen, schema, n, documents)``.

    ``schema``: the narrowest schema of all its values (``VARIANT`` where they
    differ in kind); ``seen``: its family; ``n``: documents that hold the
    field; ``documents``: objects of the source (texts that are no JSON object are not counted).
    A NULL source is a source of its own.

    One pass over the documents and one shuffle of a partial aggregate by
    (source, field): a source with a third of all documents is one row per
    field and task. The count of documents rides along as a field without a name.
    """
    parsed = df.select(F.col(source).alias("source"), F.try_parse_json(F.col(json_col)).alias("v")).where(is_object(F.col("v")))
    members = F.map_entries(F.try_variant_get("v", "$", "map<string,variant>"))
    nameless = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("variant").alias("value"))
    each = parsed.select("source", F.explode(F.concat(F.array(nameless), members)).alias("m")).select("source", "m.*")
    found = each.groupBy("source", F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("schema"), F.count(F.lit(1)).alias("n")
    )
    # over fields, of which a source has few; a source without any has no row
    documents = F.max(F.when(F.col("field").isNull(), F.col("n"))).over(Window.partitionBy("source"))
    fields = found.withColumn("documents", documents).where(F.col("field").isNotNull())
    return fields.select("source", "field", _family(F.col("schema")).alias("seen"), "schema", "n", "documents")


def schema_drift(df: DataFrame, json_col: str, source: str, fields: Sequence[Field]) -> DataFrame:
    """Discovered fields beside the declared ones -> ``(source, field, status, declared, seen, n, documents)``.

    ``status``: ``as_declared``, ``new`` (not declared), ``missing`` (declared,
    in no document of the source), ``retyped`` (of a family the declared kind would have to coerce), or
    ``null_only``. ``declared`` is the kind; NULL where there is none.
    """
    spark = df.sparkSession
    found = discover_fields(df, json_col, source)
    declared = spark.createDataFrame([(f.name, f.kind, list(FITS[f.kind])) for f in fields], "field string, declared string, fits array<string>")
    # every declared field once per source: a bounded list beside the sources' own fields
    wanted = F.array(*[F.lit(f.name) for f in fields]) if fields else F.expr("cast(array() as array<string>)")
    held = F.collect_set(F.when(F.array_contains(wanted, F.col("field")), F.col("field")))
    sources = found.groupBy("source").agg(F.max("documents").alias("documents"), held.alias("held"))
    absent = sources.select("source", F.explode(F.array_except(wanted, "held")).alias("field"), "documents")
    rows = found.drop("schema").unionByName(absent.withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    rows = rows.join(F.broadcast(declared), "field", "left")
    status = (
        F.when(F.col("declared").isNull(), "new")
        .when(F.col("n") == 0, "missing")
        .when(F.col("seen") == "null", "null_only")
        .when(F.array_contains("fits", F.col("seen")), "as_declared")
        .otherwise("retyped")
    )
    return rows.select("source", "field", status.alias("status"), "declared", "seen", "n", "documents")
