"""The coercion rules of ``json_rules`` as SQL functions of a session, for free SQL.

``register_functions(spark)`` makes temporary SQL functions:

* ``json_int(v, name [, fallback])``, ``json_long``, ``json_double``, ``json_text``: one field of a variant by its rule;
* ``json_list(v, name)``: a list field as ``array<string>``;
* ``json_elements(doc)``: a table function, ``(pos, element)`` for every record of a document;
* ``json_rejects(doc)``: ``(pos, reason, value)`` for everything in it that is no record.

They are SQL expressions, so Catalyst inlines them: a query that uses them plans
as the DataFrame form does, without a Python function. A ``name`` may hold one kind of
quote, not both.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_PATH = """CASE WHEN contains(name, "'") THEN '$["' || name || '"]' ELSE "$['" || name || "']" END"""


def _get(kind: str) -> str:
    return f"try_variant_get(v, {_PATH}, '{kind}')"


def _whole(kind: str) -> str:
    text = _get("string")
    exact = f"try_cast({text} AS decimal(38,10))"
    return (
        f"coalesce({_get(kind)}, try_cast(CASE WHEN {exact} >= 0 THEN floor({exact}) ELSE ceil({exact}) END AS {kind}), "
        f"try_cast(try_cast({text} AS double) AS {kind}), fallback)"
    )


def _finite() -> str:
    number = f"coalesce({_get('double')}, try_cast({_get('string')} AS double))"
    return f"coalesce(CASE WHEN NOT isnan({number}) AND abs({number}) < double('infinity') THEN {number} END, fallback)"


def _object(x: str) -> str:
    return f"try_variant_get({x}, '$', 'struct<__rt_probe:variant>') IS NOT NULL"


def _scalar_text() -> str:
    x = _get("variant")
    container = f"({_object(x)} OR try_variant_get({x}, '$', 'array<variant>') IS NOT NULL)"
    return f"coalesce(CASE WHEN NOT {container} THEN try_variant_get({x}, '$', 'string') END, fallback)"


def _listed() -> str:
    x = _get("variant")
    return (
        f"CASE WHEN try_variant_get({x}, '$', 'array<string>') IS NOT NULL THEN try_variant_get({x}, '$', 'array<string>') "
        f"WHEN {_object(x)} THEN cast(array() AS array<string>) "
        f"WHEN try_variant_get({x}, '$', 'string') IS NOT NULL THEN array(try_variant_get({x}, '$', 'string')) END"
    )


# (v, t) of every element of a parsed document d, as ``ingest.explode_documents`` takes them
_ELEMENTS = """
CASE
  WHEN try_variant_get(d.v, '$', 'array<variant>') IS NOT NULL
    THEN transform(try_variant_get(d.v, '$', 'array<variant>'), x -> named_struct('v', x, 't', cast(null AS string)))
  WHEN try_variant_get(d.v, '$', 'map<string,variant>') IS NOT NULL
    THEN transform(map_keys(from_json(d.t, 'map<string,string>')),
                   k -> named_struct('v', try_variant_get(d.v, '$', 'map<string,variant>')[k], 't', cast(null AS string)))
  WHEN d.v IS NULL
    THEN coalesce(transform(from_json(d.t, 'array<string>'), x -> named_struct('v', try_parse_json(x), 't', x)),
                  transform(map_values(from_json(d.t, 'map<string,string>')), x -> named_struct('v', try_parse_json(x), 't', x)))
END"""


def _of_document(body: str) -> str:
    """One generator over ``body``, an expression of the document d and its elements es: no subquery that would need a join."""
    inner = f"transform(array({_ELEMENTS}), es -> {body})[0]"
    return f"SELECT inline(transform(array(named_struct('t', doc, 'v', try_parse_json(doc))), d -> {inner})[0])"


_NUMBERED = "transform(es, (x, i) -> named_struct('pos', i, 'v', x.v, 't', x.t))"
_RECORDS = _of_document(
    f"transform(filter({_NUMBERED}, x -> {_object('x.v')}), x -> named_struct('pos', x.pos, 'element', x.v))"
)
_REJECTS = _of_document(
    f"""CASE
  WHEN es IS NULL
    THEN array(named_struct('pos', cast(null AS int), 'reason', CASE WHEN d.v IS NULL THEN 'unparsable' ELSE 'scalar_root' END, 'value', d.t))
  ELSE transform(filter({_NUMBERED}, x -> NOT ({_object('x.v')})), x -> named_struct(
    'pos', x.pos, 'reason', CASE WHEN x.v IS NULL AND x.t IS NOT NULL THEN 'unparsable_element' ELSE 'not_an_object' END,
    'value', coalesce(x.t, to_json(x.v), 'null')))
END"""
)


def _definitions() -> list[str]:
    field = "v VARIANT, name STRING"
    return [
        f"json_int({field}, fallback INT DEFAULT 0) RETURNS INT RETURN {_whole('int')}",
        f"json_long({field}, fallback BIGINT DEFAULT 0) RETURNS BIGINT RETURN {_whole('bigint')}",
        f"json_double({field}, fallback DOUBLE DEFAULT 0) RETURNS DOUBLE RETURN {_finite()}",
        f"json_text({field}, fallback STRING DEFAULT '') RETURNS STRING RETURN {_scalar_text()}",
        f"json_list({field}) RETURNS ARRAY<STRING> RETURN {_listed()}",
        f"json_elements(doc STRING) RETURNS TABLE (pos INT, element VARIANT) RETURN {_RECORDS}",
        f"json_rejects(doc STRING) RETURNS TABLE (pos INT, reason STRING, value STRING) RETURN {_REJECTS}",
    ]


def register_functions(spark: SparkSession) -> None:
    """Make the functions of this module known to the session (again, if they are)."""
    for definition in _definitions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {definition}")
