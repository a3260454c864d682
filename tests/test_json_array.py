"""A JSON array cut by byte ranges equals json.loads of the whole file, in order."""

import json
import random

import pyarrow as pa
import pytest

from conftest import rows
from recordtable.fields import Contract, Field
from recordtable.operators.ingest import explode_documents
from recordtable.plans.refresh import build_batch
from recordtable.sources.files import read_documents
from recordtable.sources.json_array import _scan, read_elements

SPLIT = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SPLIT}
    for k, v in SPLIT.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def _value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 2:
        return "".join(rng.choice('ab,"\\[]{}:\n é漢😀') for _ in range(rng.randrange(rng.choice([3, 12, 900]) if depth else 12)))
    if kind == 2:
        return rng.randrange(-10**6, 10**6)
    if kind == 3:
        return rng.choice([True, False, None, 1.5])
    if kind == 4:
        return rng.choice([[], {}, "", ",", '"', "\\", "],[", "\\\","])
    if kind == 5:
        return [_value(rng, depth + 1) for _ in range(rng.randrange(5))]
    return {f"k{i},\"": _value(rng, depth + 1) for i in range(rng.randrange(5))}


def _write(path, text):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes(text.encode())
    return str(path.parent)


def _by_file(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.source_file, r.pos)):
        assert r.pos == len(out.setdefault(r.source_file.rsplit("/", 1)[1], []))
        out[r.source_file.rsplit("/", 1)[1]].append(r.element)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_elements_of_many_files_over_many_splits(small_splits, tmp_path, seed):
    rng = random.Random(seed)
    want = {}
    for i in range(4):
        values = [_value(rng) for _ in range(rng.choice([1, 60, 300]))]
        style = {"ensure_ascii": rng.random() < 0.5, "indent": rng.choice([None, 2])}
        if i == 3:  # a root object: its values are the elements
            values = {f'"{{key [{n}],\\': v for n, v in enumerate(values)}
        path = _write(tmp_path / "in" / f"f{i}.json", rng.choice(["", " \n"]) + json.dumps(values, **style) + rng.choice(["", "\n"]))
        want[f"f{i}.json"] = list(values.values()) if i == 3 else values
    df = read_elements(small_splits, path)
    got = {f: [json.loads(e) for e in es] for f, es in _by_file(df).items()}
    assert got == want


def test_an_element_longer_than_several_splits(small_splits, tmp_path):
    values = [1, {"t": "x,]" * 3000, "l": [[{"a": ","}]] * 300}, "y" * 5000, [], 2]
    path = _write(tmp_path / "in" / "a.json", json.dumps(values))
    assert [json.loads(e) for e in _by_file(read_elements(small_splits, path))["a.json"]] == values


def test_same_records_as_json_lines(small_splits, tmp_path):
    rng = random.Random(5)
    records = [{"id": i, "name": _value(rng, 3), "tags": [_value(rng, 3)], "n": i * 7} if i % 9 else i for i in range(500)]
    array = _write(tmp_path / "array" / "a.json", json.dumps(records))
    lines = _write(tmp_path / "lines" / "a.json", "\n".join(json.dumps(r) for r in records))
    fields = [Field("id", "long", default=None), Field("name", "text"), Field("tags", "list"), Field("n", "int")]
    contract = Contract(key="id")
    got = []
    for path, layout in ((array, "array"), (lines, "lines")):
        docs = read_documents(small_splits, path, layout=layout)
        batch, rejects = build_batch(docs, "doc", fields, contract, single=True)
        in_order = [tuple(r)[:-1] for r in sorted(batch.collect(), key=lambda r: r["__seq"])]
        got.append((in_order, rows(rejects.select("reason", "value"))))
    assert got[0] == got[1]
    assert len(got[0][0]) == 444 and len(got[0][1]) == 56


@pytest.mark.parametrize("text, elements", [
    ("", []),
    (" \n ", []),
    ("[]", []),
    ("[ \n]", []),
    ("{}", []),
    ("[1]", ["1"]),
    ("7", ["7"]),
    ('"a,b"', ['"a,b"']),
    ("[1,,2]", ["1", "", "2"]),  # the gap parses as nothing
    ("[1,2", ["1", "2", "["]),  # cut off
    ('[1,"a', ["1", '"a', "["]),
    ("[1],[2]", ["1],[2"]),  # text behind the root
    ("[1] x", ["1] x"]),
    ('[{"a":1}, {"b" 2}, {"c":3}]', ['{"a":1}', ' {"b" 2}', ' {"c":3}']),  # a broken record costs itself only
    ('{"a": {"x":1}, "b,\\"": [2,3]}', [' {"x":1}', " [2,3]"]),
])
def test_empty_scalar_and_broken_files(spark, tmp_path, text, elements):
    path = _write(tmp_path / "in" / "a.json", text)
    assert _by_file(read_elements(spark, path)).get("a.json", []) == elements


def test_broken_elements_are_rejected(spark, tmp_path):
    path = _write(tmp_path / "in" / "a.json", '[{"a":1},{"a" 2},3,{"a":4}')
    records, rejects = explode_documents(read_documents(spark, path, layout="array"), "doc", [Field("a", "int")], single=True)
    assert rows(records.select("a")) == [(1,), (4,)]
    assert rows(rejects.select("reason", "value")) == [("not_an_object", "3"), ("unparsable", "["), ("unparsable", '{"a" 2}')]


def _by_character(text):
    """Quotes, and change of depth outside strings if entered outside and inside one, character by character."""
    quotes, depth, i = 0, [0, 0], 0
    while i < len(text):
        c = text[i]
        if c == "\\":
            i += 1
        elif c == '"':
            quotes += 1
        elif c in "[{]}":
            depth[quotes % 2] += 1 if c in "[{" else -1
        i += 1
    return quotes, depth[0], depth[1]


def test_scan_of_a_batch_equals_each_text_by_character():
    rng = random.Random(11)
    texts = ["", "\\", '"', "[", '\\"', "\\\\", '\\\\"', *("".join(rng.choice('a\\\\""[]{}é😀 ') for _ in range(rng.randrange(14))) for _ in range(4000))]
    rng.shuffle(texts)
    for part in (pa.array(texts), pa.array(["]["] * 3 + texts).slice(3), pa.array(texts).slice(0, 0), pa.array(["", ""])):
        quotes, depth0, depth1 = _scan(part)
        assert list(zip(quotes.tolist(), depth0.tolist(), depth1.tolist())) == [_by_character(t) for t in part.to_pylist()]
