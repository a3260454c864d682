"""Exact dedup against counting whole texts in Python."""

import hashlib
from collections import Counter, defaultdict

from cases import SF_SMALL, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from recordtable.llm.exact_dedup import drop_copies, exact_dedup


def expected(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    out = Counter()
    for t, ids in by.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for n, i in enumerate(sorted(ids, key=lambda i: (i != keep, i is None, i or 0))):
            out[i, keep, len(ids), n == 0] += 1
    return out


def decided(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept").collect())


def test_awkward_rows(spark, awkward):
    got = exact_dedup(awkward)
    assert decided(got) == expected([(r.doc_id, r.text) for r in awkward.collect()])


def test_every_prefix_length_gives_the_same(spark, awkward):
    want = expected([(r.doc_id, r.text) for r in awkward.collect()])
    for chars in (1, 4):
        assert decided(exact_dedup(awkward, prefix_chars=chars)) == want


def test_same_length_and_prefix_but_other_text(spark):
    texts = ["x" * 300 + c for c in "abca"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert decided(exact_dedup(df)) == expected(list(enumerate(texts)))


def test_full_hash_only_where_length_and_prefix_are_shared(spark):
    df = spark.createDataFrame([(1, "alone"), (2, "pair"), (3, "pair"), (4, "past")], "doc_id int, text string")
    assert {r.doc_id for r in exact_dedup(df).where("digest is not null").collect()} == {2, 3}


def test_carry(spark, awkward):
    got = exact_dedup(awkward, carry={"sha": F.sha2("text", 256)}).select("doc_id", "sha").collect()
    want = Counter((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in awkward.collect())
    assert Counter((r.doc_id, r.sha) for r in got) == want


def test_empty(spark, nothing):
    assert exact_dedup(nothing).count() == 0
    assert drop_copies(nothing).columns == nothing.columns


def test_drop_copies_keeps_one_row_and_all_columns(spark, awkward):
    left = drop_copies(awkward)
    assert left.columns == awkward.columns
    rows = left.collect()
    assert Counter(r.text or "" for r in rows) == Counter({(r.text or "") for r in awkward.collect()})
    assert {r.doc_id for r in rows if r.text and r.text.startswith("Ein")} == {3}
    assert [r.doc_id for r in rows if not r.text] == [5]  # null counts as empty
    assert [r.doc_id for r in rows if r.text and r.text.startswith("word0x0")] == [11]


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert decided(exact_dedup(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_no_python_in_the_plan(spark, awkward, capsys):
    exact_dedup(awkward).explain()
    assert "Python" not in capsys.readouterr().out
