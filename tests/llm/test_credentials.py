"""Secret scan against regular expressions and all pairs of parts in Python."""

import re

import pytest
from cases import SF_ORACLE, awkward, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordtable.llm import credentials as C
from recordtable.llm.queries import QUERIES

PATTERNS = {
    "assign": (re.compile(C.ASSIGN, re.A), 2, 12, 10**9),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18, 10**9),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16, 10**9),
}


def base_spans(text):
    found = []
    for kind, (pattern, group, least, most) in PATTERNS.items():
        found += [(m.start(), C.KINDS.index(kind), m.end()) for m in pattern.finditer(text or "") if least <= len(m[group]) <= most]
    return sorted(found)


def all_spans(text, scope=C.SCOPE):
    text = text or ""
    base = base_spans(text)
    weak = [(m.start(), 3, m.end()) for m in re.compile(C.WEAK_ID, re.A).finditer(text)]
    weak += [(m.start(), 4, m.end()) for m in re.compile(C.ASSIGN, re.A).finditer(text) if 4 <= len(m[2]) < 12]
    weak += [(m.start(), 4, m.end()) for m in re.compile(C.KEY_RUN).finditer(text)]
    weak += [(m.start(), 5, m.end()) for m in re.compile(C.ENDPOINT, re.A).finditer(text)]
    weak = [w for w in weak if not any(b[0] <= w[0] and w[2] <= b[2] for b in base)]

    def near(w, c):
        return any(C.CLASS_OF[p[1]] == c and max(p[0] - w[2], w[0] - p[2]) <= scope for p in base + weak)

    rules = {3: lambda w: near(w, 1), 4: lambda w: near(w, 0) or near(w, 2), 5: lambda w: near(w, 0) and near(w, 1)}
    return sorted([*base, *{w for w in weak if rules[w[1]](w)}])


def scan(df):
    return {r.doc_id: (sorted(map(tuple, r.base)), sorted(map(tuple, r.spans)), [tuple(s) for s in r.spans]) for r in C.scan_secrets(df).collect()}


PIECES = [
    "password=", "Token : '", "secret:", 'api_key" = "', "apikey=", "AKIA", "ABCDEF0123456789XY", "deadbeef", "0123456789abcdef",
    " ", "\n", "é😀", ".", "user=bob", "client_id: x1", "https://h.example/x", "s3://b", "longenoughvalue", "short", "Z" * 40, " " * 130, "=", ":",
]


def cases():
    texts = []

    @settings(max_examples=150, database=None, derandomize=True)
    @given(st.lists(st.sampled_from(PIECES), max_size=14))
    def collect(parts):
        texts.append("".join(parts))

    collect()
    return texts


def test_made_up_texts(spark):
    texts = cases()
    got = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"))
    for i, t in enumerate(texts):
        assert got[i][0] == base_spans(t), t
        assert got[i][1] == all_spans(t), t
        assert got[i][2] == got[i][1]  # in order
    assert sum(len(g[1]) > len(g[0]) for g in got.values()) > 10  # linking had work


@pytest.mark.parametrize("gap,linked", [(C.SCOPE, True), (C.SCOPE + 1, False)])
def test_scope_is_exact(spark, gap, linked):
    for lead in (0, 3, 250, 256, 511):
        text = "." * lead + "user=bob" + " " * gap + "token=abcdef"
        spans = scan(spark.createDataFrame([(1, text)], "doc_id int, text string"))[1][1]
        assert bool(spans) == linked and spans == all_spans(text)


def test_many_parts_in_one_text(spark):
    text = "user=bob token=abcd https://x.y " * 3000
    got = scan(spark.createDataFrame([(1, text)], "doc_id int, text string"))[1]
    assert len(got[1]) == 9000


def test_work_grows_with_the_text(spark):
    """40,000 matches, weak parts inside and outside base spans: in proportion, not squared (squared, this takes minutes)."""
    text = "token=abcdefghijklmnop user=bob password=https://h.example/x " * 10_000
    got = scan(spark.createDataFrame([(1, text)], "doc_id int, text string"))[1]
    one = all_spans(text[: len(text) // 10_000 * 3])
    step = len(text) // 10_000
    middle = [s for s in one if step <= s[0] < 2 * step]
    assert got[1] == sorted((a + step * i, k, b + step * i) for i in range(-1, 9_999) for a, k, b in middle)


def test_repeated_rows_of_a_hot_text(spark):
    text = "user=bob token=abcdef " * 20
    df = spark.range(3000).select(F.lit(None).cast("int").alias("doc_id"), F.lit(text).alias("text"))
    got = C.scan_secrets(df).select(F.size("spans").alias("n")).groupBy("n").count().collect()
    assert [tuple(r) for r in got] == [(40, 3000)]


def test_awkward_rows(spark, awkward, nothing):
    rows = C.scan_secrets(awkward).collect()
    assert len(rows) == awkward.count() and not any(r.spans for r in rows)
    assert C.scan_secrets(nothing).count() == 0
    same = spark.createDataFrame([(1, "user=bob token=abcd")] * 3, "doc_id int, text string")
    assert [len(r.spans) for r in C.scan_secrets(same).collect()] == [2, 2, 2]


def test_values(spark):
    df = spark.createDataFrame([(1, "é password=abcdefghijkl x")], "doc_id int, text string")
    assert [tuple(r) for r in C.span_values(df, C.scan_secrets(df)).collect()] == [(1, "assign", 2, 23, "password=abcdefghijkl")]


def test_table(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text")
    want = {r.doc_id: (base_spans(r.text), all_spans(r.text)) for r in docs.collect()}
    assert {i: g[:2] for i, g in scan(docs).items()} == want


def test_no_python_in_the_plan(spark, awkward, capsys):
    C.scan_secrets(awkward).explain()
    assert "Python" not in capsys.readouterr().out


def test_query_measures_gaps(spark, tmp_path):
    jwt, url = "token=" + "eyJhbG.x-" * 33, "https://h.example/" + "path/" * 80
    texts = [
        jwt + " client_id=abc",
        "client_id=abc " + jwt,
        url + " user=bob token=abcdef",
        "user=bob token=abcdef " + url,
        *(jwt + " " * n + "client_id=abc" for n in (255, 256, 257)),
        *("client_id=abc" + " " * n + jwt for n in (255, 256, 257)),
        *(f"user=bob {'kE' * (n // 2)}{'+' * (n % 2)} x" for n in (39, 40, 43, 64, 88)),
        "kE" * 32,
        *cases(),
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.spans for r in QUERIES["op8_secrets"](spark, str(tmp_path)).collect()}
    assert got == {i: ",".join(f"{C.KINDS[k]}:{a}:{b}" for a, k, b in all_spans(t)) for i, t in enumerate(texts)}
    kinds = [{s.split(":")[0] for s in got[i].split(",") if s} for i in range(16)]
    assert [len(k) for k in kinds] == [2, 2, 3, 3, 2, 2, 1, 2, 2, 1, 0, 2, 2, 2, 2, 0]
