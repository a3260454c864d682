"""Column expressions that read JSON values with explicit coercion rules.

All rules work on a ``VARIANT`` column (``try_parse_json``) and use only
``try_*`` built-ins, so they stay JVM-side, run inside whole-stage codegen
and never raise under ANSI mode.

Rules (see README "Semantics"):

* int / long: a JSON integer, a numeric string (padded or fractional, which
  truncates toward zero) or a boolean (1/0) gives the number; anything else,
  including out-of-range values, gives the default.
* double: a finite JSON number, numeric string or boolean; else the default (also for NaN and infinity).
* text: a scalar's text; JSON null, arrays and objects give the default.
* list: an array gives its elements as text (nulls kept here, skipped by
  ``join_list``); a scalar gives a one-element list; an object gives an
  empty list; absent or null gives NULL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordtable.fields import Field

_SIMPLE_KEY = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def json_path(name: str) -> str | None:
    """Variant path for one top-level key, or None when no path can spell it.

    Paths take ``$.key``, ``$['key']`` or ``$["key"]`` and have no escapes,
    so a key holding both quote characters has no path.
    """
    if _SIMPLE_KEY.match(name):
        return f"$.{name}"
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    return None


def _at(v: Column, name: str | None, target: str) -> Column:
    if name is None:
        return F.try_variant_get(v, "$", target)
    path = json_path(name)
    if path is not None:
        return F.try_variant_get(v, path, target)
    member = F.try_variant_get(v, "$", "map<string,variant>").getItem(name)
    return F.try_variant_get(member, "$", target)


def _lit(value, spark_type: str) -> Column:
    return F.lit(value).cast(spark_type)


def has_field(v: Column, name: str) -> Column:
    """True when the key is present, including an explicit JSON null."""
    return _at(v, name, "variant").isNotNull()


def is_object(x: Column) -> Column:
    """True when variant ``x`` is a JSON object.

    Casting to a one-field struct succeeds exactly for objects (the field
    may be absent) and looks up one key, where ``schema_of_variant`` would
    walk the whole value.
    """
    return F.try_variant_get(x, "$", "struct<__rt_probe:variant>").isNotNull()


def _is_container(x: Column) -> Column:
    return is_object(x) | F.try_variant_get(x, "$", "array<variant>").isNotNull()


def json_number(v: Column, name: str | None, spark_type: str, default=0) -> Column:
    """Integer-like or double read of one field with the numeric rule."""
    direct = _at(v, name, spark_type)
    text = _at(v, name, "string")
    if spark_type == "double":
        out = F.coalesce(direct, text.try_cast("double"))
        out = F.when(~F.isnan(out) & (F.abs(out) < F.lit(float("inf"))), out)  # a JSON number is finite
    else:
        # decimals first: a double has 53 bits and would move a long key to its neighbour
        exact = text.try_cast("decimal(38,10)")
        out = F.coalesce(direct, F.when(exact >= 0, F.floor(exact)).otherwise(F.ceil(exact)).try_cast(spark_type),
                         text.try_cast("double").try_cast(spark_type))
    if default is not None:
        out = F.coalesce(out, _lit(default, spark_type))
    return out


def json_int(v: Column, name: str | None, default=0) -> Column:
    return json_number(v, name, "int", default)


def json_long(v: Column, name: str | None, default=0) -> Column:
    return json_number(v, name, "bigint", default)


def json_double(v: Column, name: str | None, default=0.0) -> Column:
    return json_number(v, name, "double", default)


def json_text(v: Column, name: str | None, default="") -> Column:
    x = _at(v, name, "variant")
    text = F.when(_is_container(x), F.lit(None).cast("string")).otherwise(
        F.try_variant_get(x, "$", "string")
    )
    if default is not None:
        text = F.coalesce(text, F.lit(default))
    return text


def json_list(v: Column, name: str | None) -> Column:
    x = _at(v, name, "variant")
    as_array = F.try_variant_get(x, "$", "array<string>")
    scalar = F.try_variant_get(x, "$", "string")
    return (
        F.when(as_array.isNotNull(), as_array)
        .when(is_object(x), F.array().cast("array<string>"))
        .when(scalar.isNotNull(), F.array(scalar))
    )


def join_list(c: Column | str, sep: str = ",") -> Column:
    """List column to delimited text; NULL stays NULL, [] gives '', NULL elements are skipped."""
    return F.array_join(F.col(c) if isinstance(c, str) else c, sep)


def read_field(v: Column, f: Field) -> Column:
    """Apply ``f``'s rule to variant ``v`` and name the result ``f.out``."""
    if f.kind == "int":
        c = json_int(v, f.name, f.default)
    elif f.kind == "long":
        c = json_long(v, f.name, f.default)
    elif f.kind == "double":
        c = json_double(v, f.name, f.default)
    elif f.kind == "text":
        c = json_text(v, f.name, f.default)
    else:
        c = json_list(v, f.name)
        if f.default is not None:
            c = F.coalesce(c, F.lit(f.default))
    return c.alias(f.out)

