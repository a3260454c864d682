"""Discovered fields and their drift from declared ones."""

from conftest import rows
from recordtable.fields import Field
from recordtable.operators.discover import discover_fields, schema_drift

DOCS = [
    ("a", '{"id": 1, "name": "x", "n": 1.5, "tags": ["t"], "o": {"p": 1}, "b": true, "z": null}'),
    ("a", '{"id": 20000000000, "name": null, "n": 2, "tags": []}'),
    ("a", "[1]"),
    ("a", '{"id": '),
    ("a", None),
    ("b", '{"id": "1", "name": 5, "mix": 1, "we\\"ird key.": 0}'),
    ("b", '{"mix": "x"}'),
    ("b", "{}"),
    (None, '{"id": 3}'),
    ("none", "7"),
]
FIELDS = (Field("id", "long"), Field("name", "text"), Field("n", "double"), Field("tags", "list"), Field("z", "int"))


def test_families_and_counts(spark):
    df = spark.createDataFrame(DOCS, "source string, field string")  # names that clash with the result's
    got = {(r.source, r.field): (r.seen, r.n, r.documents) for r in discover_fields(df, "field", "source").collect()}
    assert got == {
        ("a", "id"): ("whole", 2, 2), ("a", "name"): ("text", 2, 2), ("a", "n"): ("fraction", 2, 2), ("a", "tags"): ("list", 2, 2),
        ("a", "o"): ("object", 1, 2), ("a", "b"): ("boolean", 1, 2), ("a", "z"): ("null", 1, 2),
        ("b", "id"): ("text", 1, 3), ("b", "name"): ("whole", 1, 3), ("b", "mix"): ("mixed", 2, 3), ("b", 'we"ird key.'): ("whole", 1, 3),
        (None, "id"): ("whole", 1, 1),
    }


def test_drift(spark):
    df = spark.createDataFrame(DOCS, "src string, doc string")
    got = {(r.source, r.field): r.status for r in schema_drift(df, "doc", "src", FIELDS).collect()}
    assert {f: s for (src, f), s in got.items() if src == "a"} == {
        "id": "as_declared", "name": "as_declared", "n": "as_declared", "tags": "as_declared", "z": "null_only", "o": "new", "b": "new",
    }
    assert {f: s for (src, f), s in got.items() if src == "b"} == {
        "id": "retyped", "name": "retyped", "mix": "new", 'we"ird key.': "new", "n": "missing", "tags": "missing", "z": "missing",
    }
    assert got[(None, "id")] == "as_declared" and got[(None, "name")] == "missing"
    assert not any(src == "none" for src, _ in got)


def test_nothing_declared_and_nothing_landed(spark):
    df = spark.createDataFrame(DOCS, "src string, doc string")
    assert {r.status for r in schema_drift(df, "doc", "src", ()).collect()} == {"new"}
    assert rows(schema_drift(df.limit(0), "doc", "src", FIELDS)) == []
