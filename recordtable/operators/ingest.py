"""Ingest: JSON text -> typed rows (W01-W04).

Parsing happens on executors, one ``VARIANT`` per row; nothing is gathered
on the driver. A document is one JSON text holding many records (an array,
or an object whose values are records).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.fields import Field
from recordtable.functions.json_rules import is_object, read_field

_V = "__rt_v"
_E = "__rt_e"


def _cols(names: Iterable[str] | None) -> list[str]:
    return list(names or [])


def parse_records(
    df: DataFrame,
    json_col: str,
    fields: Sequence[Field],
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """One JSON object per row -> ``keep`` columns plus one typed column per field."""
    keep = _cols(keep)
    parsed = df.select(*keep, F.try_parse_json(F.col(json_col)).alias(_V))
    return parsed.select(*keep, *[read_field(F.col(_V), f) for f in fields])


def _element_list(text: Column, v: Column) -> Column:
    """Elements of a document as ``array<struct<v variant, t string>>``; NULL if it is no array or object.

    A document that parses as one variant gives variants (a root object's in
    document order). One that does not, because it is larger than a variant
    may be or because a record repeats a key, is cut into the texts of its
    elements, which are parsed one by one: a bad record costs itself only.
    """
    by_key = F.from_json(text, "map<string,string>")
    values = F.try_variant_get(v, "$", "map<string,variant>")
    nothing = F.lit(None).cast("string")

    def whole(x: Column) -> Column:
        return F.struct(x.alias("v"), nothing.alias("t"))

    def single(x: Column) -> Column:
        return F.struct(F.try_parse_json(x).alias("v"), x.alias("t"))

    items = F.try_variant_get(v, "$", "array<variant>")
    return (
        F.when(items.isNotNull(), F.transform(items, whole))
        .when(values.isNotNull(), F.transform(F.map_keys(by_key), lambda k: whole(values[k])))
        .when(v.isNull(), F.coalesce(
            F.transform(F.from_json(text, "array<string>"), single),
            F.transform(F.map_values(by_key), single),
        ))
    )


def explode_documents(
    df: DataFrame,
    json_col: str,
    fields: Sequence[Field],
    keep: Iterable[str] | None = None,
    single: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Documents -> ``(records, rejects)``.

    ``single=True``: every document is one record (JSON Lines of objects);
    a document that is not an object is rejected as ``not_an_object``.

    ``records``: ``keep`` columns, ``pos`` (position in the document) and one
    typed column per field, for every element that is a JSON object.

    ``rejects``: ``keep`` columns, ``pos``, ``reason`` and ``value`` (JSON
    text) for every element that is not an object (``not_an_object``) or that
    does not parse (``unparsable_element``, e.g. a repeated key), and
    for every document that does not parse (``unparsable``, pos NULL) or
    whose root is a scalar (``scalar_root``, pos NULL). An empty array gives
    neither records nor rejects.

    Both outputs share the parse; persist ``df`` upstream if both are used
    on a large input. One document is handled by one task, so prefer many
    bounded documents (JSON Lines, many files) over one huge array.
    """
    keep = _cols(keep)
    docs = df.select(*keep, F.col(json_col).alias("__rt_text"), F.try_parse_json(F.col(json_col)).alias(_V))
    if single:
        one = F.struct(F.col(_V).alias("v"), F.lit(None).cast("string").alias("t"))
        elements = F.when(F.col(_V).isNotNull(), F.array(one))
    else:
        elements = _element_list(F.col("__rt_text"), F.col(_V))

    exploded = docs.select(*keep, F.posexplode(elements).alias("pos", _E))
    v, text = F.col(f"{_E}.v"), F.col(f"{_E}.t")
    obj = is_object(v)

    records = exploded.where(obj).select(*keep, "pos", *[read_field(v, f) for f in fields])

    element_rejects = exploded.where(~obj).select(
        *keep,
        "pos",
        F.when(v.isNull() & text.isNotNull(), F.lit("unparsable_element")).otherwise(F.lit("not_an_object")).alias("reason"),
        F.coalesce(text, F.to_json(v), F.lit("null")).alias("value"),
    )
    document_rejects = docs.where(elements.isNull()).select(
        *keep,
        F.lit(None).cast("int").alias("pos"),
        F.when(F.col(_V).isNull(), F.lit("unparsable")).otherwise(F.lit("scalar_root")).alias("reason"),
        F.col("__rt_text").alias("value"),
    )
    return records, element_rejects.unionByName(document_rejects)


def map_columns(
    df: DataFrame,
    mapping: Mapping[str, str],
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Rename and project in one ``select``: ``{source: target}`` plus unchanged ``keep`` columns."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()], *_cols(keep))


def to_documents(
    df: DataFrame,
    group_cols: Sequence[str],
    record_cols: Sequence[str],
    chunk_key: str,
    chunk_size: int = 256,
    doc_col: str = "doc",
) -> DataFrame:
    """Fold rows into JSON array documents of at most ``chunk_size`` records.

    Rows are grouped by ``group_cols`` and by ``chunk_key div chunk_size``;
    with a unique integer ``chunk_key`` no document holds more than
    ``chunk_size`` records, so a hot group is spread over many bounded
    documents instead of one unbounded one. A document that would hold more
    (``chunk_key`` repeats or is NULL) fails the job instead of growing.
    """
    if chunk_size < 1:
        raise ValueError("chunk_size must be >= 1")
    chunk = F.expr(f"`{chunk_key}` div {int(chunk_size)}").alias("chunk")
    return df.groupBy(*[F.col(c) for c in group_cols], chunk).agg(
        F.when(
            F.count(F.lit(1)) > chunk_size, F.raise_error(F.lit(f"chunk key {chunk_key} is not unique or is NULL"))
        ).otherwise(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in record_cols])))).alias(doc_col)
    )
