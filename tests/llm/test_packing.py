"""Packing: ids against the tokenizers library, bounds against exhaustive search, packings against their rules."""

from collections import defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from cases import SF_SMALL, awkward, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordtable.llm import bytebpe
from recordtable.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
ENCODER = bytebpe.encoder(PATH)
TOKENIZER = Tokenizer.from_file(PATH)


@settings(deadline=None, max_examples=300)
@given(st.text(max_size=80) | st.text(alphabet=st.sampled_from("ab1 2.é\n\t'sß世  <|endoftext>"), max_size=80))
def test_ids_are_those_of_the_tokenizers_library(text):
    assert ENCODER.encode(text) == ENCODER.ids_of(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_with_special_token():
    text = "a<|endoftext|> b<|endoftext|><|endoftext"
    assert ENCODER.encode(text) == TOKENIZER.encode(text, add_special_tokens=False).ids


RUN = 1_000_000
LONG_RUNS = [" " * RUN + "x", "\n" * RUN + "x", "\t" * RUN, " \n\t\r" * (RUN // 4) + "y", "a" + " " * RUN + "b", "a\n" + "\u3000 " * (RUN // 2) + "é", "a" * RUN]


@pytest.mark.parametrize("n", range(len(LONG_RUNS)))
def test_long_runs(n):
    assert ENCODER.encode(LONG_RUNS[n]) == ENCODER.ids_of(LONG_RUNS[n]) == TOKENIZER.encode(LONG_RUNS[n], add_special_tokens=False).ids


def test_long_runs_through_the_operator(spark):
    docs = spark.createDataFrame(list(enumerate(LONG_RUNS)), "doc_id long, text string").repartition(4)
    rows = P.pack_documents(docs, PATH, carry={}).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n - 1 for r in rows} == {i: len(TOKENIZER.encode(t, add_special_tokens=False).ids) for i, t in enumerate(LONG_RUNS)}


@cache
def least_bins(items, capacity):
    """Exact number of bins, by trying every place of the largest item left."""

    def search(left, spaces, best):
        if not left:
            return min(best, len(spaces))
        if len(spaces) >= best:
            return best
        n, rest = left[0], left[1:]
        for s in sorted(set(s for s in spaces if s >= n)):
            i = spaces.index(s)
            best = search(rest, tuple(sorted((*spaces[:i], *spaces[i + 1 :], s - n))), best)
        return search(rest, tuple(sorted((*spaces, capacity - n))), best)

    return search(tuple(sorted(items, reverse=True)), (), len(items) + 1)


@settings(deadline=None, max_examples=150)
@given(st.lists(st.integers(1, 19), min_size=1, max_size=8))
def test_bound_and_best_fit_enclose_the_optimum(lengths):
    bound = P.lower_bound(np.bincount(lengths, minlength=21), 20)
    seq, offset, _ = P.best_fit(np.array(lengths), 20)
    best = least_bins(tuple(lengths), 20)
    assert bound <= best <= seq.max() + 1
    fill = defaultdict(int)
    for i in sorted(range(len(lengths)), key=lambda i: (seq[i], offset[i])):
        assert fill[seq[i]] == offset[i]
        fill[seq[i]] += lengths[i]
    assert max(fill.values()) <= 20


def test_dual_feasible_bounds_beat_the_sum():
    assert P.lower_bound(np.bincount([11] * 6, minlength=21), 20) == 6  # over half: one each
    assert P.lower_bound(np.bincount([7] * 9, minlength=21), 20) == 5  # over a third: two each
    assert P.lower_bound(np.bincount([8, 8, 8, 12, 13], minlength=21), 20) == 3


def check(rows, capacity):
    by_sequence, by_row = defaultdict(list), defaultdict(list)
    for r in rows:
        assert 1 <= r.length <= capacity
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence), by_row


@pytest.mark.parametrize("group_rows", [10, 40, 100_000])
def test_rounds_of_exchange(spark, group_rows):
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 65, 400)
    pieces = spark.createDataFrame([(i, int(n)) for i, n in enumerate(lengths)], "number long, length long")
    rows = pieces.join(P.pack(pieces, 64, group_rows), "number").collect()
    assert sorted(r.number for r in rows) == list(range(400))
    used, _ = check(rows, 64)
    bound = P.lower_bound(np.bincount(lengths, minlength=65), 64)
    one_group = P.best_fit(lengths, 64)[0].max() + 1
    assert bound <= one_group <= used <= 1.06 * one_group
    if used == bound:
        assert all(r.certified for r in rows)


def test_round_trip(spark, awkward):
    rows = P.pack_documents(awkward, PATH, capacity=64).collect()
    check(rows, 64)
    docs = defaultdict(list)
    for r in rows:
        docs[r.doc_id].append(r)
    want = defaultdict(list)
    for d in awkward.collect():
        want[d.doc_id].append([*TOKENIZER.encode(d.text or "", add_special_tokens=False).ids, 2])
    assert set(docs) == set(want)
    for i, pieces in docs.items():
        if len(want[i]) > 1:
            assert sum(r.length for r in pieces) == sum(map(len, want[i]))
            continue
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        ids, at = [], 0
        for r in pieces:
            assert r.start == at and len(r.ids) == 4 * r.length
            ids += np.frombuffer(r.ids, "<u4").tolist()
            at += r.length
        assert ids == want[i][0]
        assert all(r.length == 64 for r in pieces[1:])  # only the first may be shorter


def test_carry_and_empty(spark, awkward, nothing):
    rows = P.pack_documents(awkward, PATH, carry={"n": F.length("ids")})
    assert "ids" not in rows.columns
    assert all(r.n == 4 * r.length for r in rows.collect())
    assert P.pack_documents(nothing, PATH).count() == 0


def test_table_comes_near_the_bound(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = P.pack_documents(docs, PATH, carry={}).collect()
    used, _ = check(rows, 1024)
    bound = P.lower_bound(np.bincount([r.length for r in rows], minlength=1025), 1024)
    assert bound <= used <= 1.02 * bound + 1
