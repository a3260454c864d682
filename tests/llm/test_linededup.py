"""Fuzzy line dedup against comparing every pair of lines."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import SF_SMALL, awkward, nothing  # noqa: F401
from unionfind import roots

from recordtable.llm import linededup as D


def brute(rows, threshold=D.THRESHOLD):
    """(id, line number) -> the place that stays."""
    places = defaultdict(list)
    for i, text in rows:
        for no, line in enumerate((text or "").split("\n")):
            if line.strip(D.WHITE):
                places[line.strip(D.WHITE).lower()].append((i, no))
    lines = list(places)
    sets = [D.shingle_set(x) for x in lines]
    links = []
    for i in range(len(lines)):
        for j in range(i + 1, len(lines)):
            if min(len(sets[i]), len(sets[j])) >= threshold * max(len(sets[i]), len(sets[j])):
                both = len(sets[i] & sets[j])
                if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    links.append((i, j))
    root = roots(range(len(lines)), links)
    first = {}
    for n, line in enumerate(lines):
        at = min(places[line], key=lambda p: (p[0] is not None, p))
        first[root[n]] = min(first.get(root[n], at), at, key=lambda p: (p[0] is not None, p))
    return {p: first[root[n]] for n, line in enumerate(lines) for p in places[line]}


def decided(df):
    return {(r.doc_id, r.line_no): (r.keep_id, r.keep_line) for r in df.collect()}


def test_signatures_do_not_depend_on_the_batch():
    lines = ["short", "é😀", "a line of some length here", "x" * 5000, "another line of some length", ""] * 3
    with np.errstate(over="ignore"):
        whole = D.signatures(pa.array(lines))
        assert all((D.signatures(pa.array([x])) == whole[i]).all() for i, x in enumerate(lines))
        assert (D.signatures(pa.array(["skip", *lines]).slice(1)) == whole).all()


def test_shingle_hashes_of_odd_lines():
    lines = ["", "a", "ab", "a\x00", "abcdefg", "abcdefgabcdefg", "é😀é😀é😀é😀é"]
    with np.errstate(over="ignore"):
        flat, at = D.shingle_hashes(pa.array(lines))
        alone = [D.shingle_hashes(pa.array([x]))[0].tolist() for x in lines]
    assert [flat[a:b].tolist() for a, b in zip(at, at[1:])] == alone
    assert [len(x) for x in alone] == [len(D.shingle_set(x)) for x in lines]
    assert len({tuple(x) for x in alone}) == len(lines)


def test_recall_of_the_bands():
    rng = np.random.default_rng(4)
    found = alike = 0
    with np.errstate(over="ignore"):
        for _ in range(150):
            line = list("".join(rng.choice(list("abcdefgh "), 160)))
            other = line.copy()
            for at in rng.choice(160, 2, replace=False):
                other[at] = "z"
            a, b = "".join(line), "".join(other)
            sa, sb = D.shingle_set(a), D.shingle_set(b)
            if len(sa & sb) >= 0.8 * len(sa | sb):
                keys = D.band_keys(D.signatures(pa.array([a, b])))
                alike, found = alike + 1, found + bool((keys[0] == keys[1]).any())
    assert alike > 50 and found >= 0.98 * alike


def test_forest_connects_what_is_alike():
    rng = np.random.default_rng(1)
    lines = []
    for c in range(4):
        base = list("".join(rng.choice(list("abcdefghij "), 120)))
        for _ in range(25):
            x = base.copy()
            for at in rng.choice(120, rng.integers(0, 5), replace=False):
                x[at] = "z"
            lines.append("".join(x))
    sets = [D.shingle_set(x) for x in lines]
    links = [(i, j) for i in range(100) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    with np.errstate(over="ignore"):
        got = [tuple(x) for x in D.run_links(np.zeros(100, np.int64), pa.array(lines), 0.8).tolist()]
        assert [len(x) for x in sets] == np.diff(D.shingle_hashes(pa.array(lines))[1]).tolist()
        pairs = pa.array([x for i, j in [(0, 1), (0, 30), (30, 31), (2, 3)] for x in (lines[i], lines[j])])
        two = D.run_links(np.repeat(np.arange(4), 2), pairs, 0.8).tolist()
    assert [t[0] // 2 for t in two] == [n for n, p in enumerate([(1, 0), (30, 0), (31, 30), (3, 2)]) if p in links]
    assert set(got) <= {(i, j) for i, j in links} | {(j, i) for i, j in links}
    assert roots(range(100), got) == roots(range(100), links)
    assert len(got) < 100


@pytest.mark.parametrize("block", [2, 7, 16, 2048])
def test_hot_keys_in_blocks(spark, block):
    lines = [f"the same long line with a small change at its very end {i % 37}" for i in range(60)] + ["quite another line"]
    rows = [(1, i, -i, x) for i, x in enumerate(lines)] + [(2, 5, -5, lines[5])]
    got = D.line_links(spark.createDataFrame(rows, "run long, h long, g long, line string"), block=block).collect()
    sets = [D.shingle_set(x) for x in lines]
    links = [(i, j) for i in range(61) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert roots(range(61), [(r.a.h, r.b.h) for r in got]) == roots(range(61), links)


def test_wide_keys_are_cut_by_their_rarest_shingles(spark):
    rng = np.random.default_rng(7)
    lines = [f"order {rng.integers(10**12)} of customer {rng.integers(10**12)} was sent on the same day" for _ in range(150)]
    lines += [x + "s" for x in lines[:40]] + ["ab", "abc"]
    df = spark.createDataFrame([(1, i, -i, x) for i, x in enumerate(lines)], "run long, h long, g long, line string")
    got = D.line_links(df, block=8).collect()
    sets = [D.shingle_set(x) for x in lines]
    n = len(lines)
    links = [(i, j) for i in range(n) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert links and roots(range(n), [(r.a.h, r.b.h) for r in got]) == roots(range(n), links)
    assert D.prefix_runs(df, 0.8).count() < 12 * n  # blocks would make 25 rows of each line


def test_white_space_at_the_ends_of_a_line(spark):
    rows = [(1, "\t\n\t"), (2, "a line that stays here\r\n\u3000\xa0 \t\n x y\tz\r"), (3, "\ta line that stays here \r\t"), (4, "x y\tz")]
    got = decided(D.dedup_lines(spark.createDataFrame(rows, "doc_id int, text string")))
    assert got == brute(rows) == {(2, 0): (2, 0), (3, 0): (2, 0), (2, 2): (2, 2), (4, 0): (2, 2)}


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert decided(D.dedup_lines(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(spark, awkward, nothing):
    rows = awkward.where("doc_id is null or doc_id <> 11").collect()
    got = D.dedup_lines(awkward.where("doc_id is null or doc_id <> 11"))
    assert decided(got) == brute([(r.doc_id, r.text) for r in rows])
    assert D.dedup_lines(nothing).count() == 0


def test_texts_without_the_lines(spark):
    rows = [(1, "One line that is here.\n\nAnd a second one"), (2, "one line that is here.  \nNew"), (3, None), (4, "New\nNew\n"), (5, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id int, text string, row_key string")
    left = D.without_lines(docs, D.dedup_lines(docs))
    assert left.columns == docs.columns
    assert {r.doc_id: r.text for r in left.collect()} == {1: rows[0][1], 2: "New", 3: None, 4: "", 5: ""}
