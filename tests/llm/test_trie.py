"""Trie of conversations against plain Python sets of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from cases import SF_SMALL
from pyspark.sql import functions as F

from recordtable.llm import trie as T
from recordtable.llm.queries import QUERIES, regrown

SCHEMA = "conv_id long, turn long, role string, text string, depth string, seq string, name long, words string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def content(role, text):
    role, text = role or "", text or ""
    return role, text, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def sequences(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, content(role, text)[2], content(role, text)[:2]))
    return {c: [x[3] for x in sorted(v)] for c, v in by.items()}


def slow_regrown(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seqs.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[h:]
    return out


def slow_trie(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        leaves[p] = sum(leaves[k] for k in children[p]) or 1
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in children[p])
        ends = ",".join(map(str, sorted(c for c in members[p] if len(seqs[c]) == len(p))))
        out.append(
            (
                min(members[p]),
                len(p),
                min(members[p[:-1]]) if p else None,
                len(members[p]),
                len(children[p]),
                leaves[p],
                saved[p],
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3, "z") for r in rows], SCHEMA).repartition(3)


def result(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


AWKWARD = [
    (1, 0, "user", "Hello there"),
    (1, 1, "bot", "Hi"),
    (2, 0, "user", "Hello there"),
    (2, 1, "bot", "Hi"),
    (2, 2, "user", " one\ttwo\nthree  \x0b"),
    (3, None, "user", "Hello there"),
    (3, 5, None, None),
    (4, 7, "", ""),
    (4, 7, "", ""),
    (4, 7, "b", "tie"),
    (4, None, None, "x"),
    (None, 0, "user", "no id"),
    (-5, 0, "user", "Hello there"),
    (-5, 1, "bot", "Hi"),
    (2**62, -3, "us", "er:"),
    (2**62, -2, "user", ":"),
    (9, 0, "user", "long " * 20_000),
    (10, 0, "user", "long " * 20_000),
]


def test_awkward(spark):
    assert result(T.conversation_trie(table(spark, AWKWARD))) == slow_trie(sequences(AWKWARD))


def test_nothing(spark):
    assert T.conversation_trie(table(spark, [])).collect() == []
    assert T.conversation_trie(table(spark, [(None, 1, "a", "b")])).collect() == []


def test_single_turns(spark):
    rows = [(c, 0, "u", "same" if c % 2 else f"own {c}") for c in range(10)]
    assert result(T.conversation_trie(table(spark, rows))) == slow_trie(sequences(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_depths(spark, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(60):
        for turn in range(rng.choice([1, 2, 3, 4, 5, 8, 16, 17, 33])):
            rows.append((c * 3 - 40, turn, "u", rng.choice(["a a", "b", "a a"])))
    assert result(T.conversation_trie(table(spark, rows))) == slow_trie(sequences(rows))


def test_one_conversation_and_one_opening_hold_a_third_each(spark):
    rows = [(7, t, "u", f"w {t % 7}") for t in range(400)]
    rows += [(1000 + c, 0, "u", "the same opening") for c in range(400)]
    rows += [(3000 + c, t, "u", f"{c % 11}" if t else "the same opening") for c in range(130) for t in range(3)]
    assert result(T.conversation_trie(table(spark, rows))) == slow_trie(sequences(rows))


def test_turnless_and_missing_bases(spark):
    rows = [(c, t, "u", f"{t}") for c in (0, 1, 2, 3, 21, 22, 23, 24, 25, 26, 27, 45, 46, -3, -24, -20) for t in range(c % 5)]
    seqs = slow_regrown(sequences(rows))
    assert any(not s for s in seqs.values())
    turns = T.turns(table(spark, rows))
    steps, ids = regrown(turns)
    assert result(T.prefix_trie(steps, ids)) == slow_trie(seqs)
    # no sequence has a turn
    none = steps.where("false")
    assert result(T.prefix_trie(none, ids)) == slow_trie({c: [] for c in seqs})


def test_runs_of_ids_are_joined_in_order(spark):
    ids = [-70_000, -5, 0, 3, 4095, 4096, 9_999, 10_000, 10**12]
    ends = spark.createDataFrame([(n, 2, i) for i in ids for n in (1, 2)], "name long, depth long, seq long").repartition(4)
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(tuple(r) for r in T.end_digests(ends).collect()) == [(1, 2, want), (2, 2, want)]


def test_words(spark):
    texts = ["", " ", "a", " a  b\t\x0b\x0c\r\nc ", "a\xa0b é", "\x1cx y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(T.word_count(F.col("t")).alias("n"), "t")
    assert {r.t: r.n for r in df.collect()} == {t: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts}


def test_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op12_conversation_trie"](spark, SF_SMALL)) == slow_trie(slow_regrown(sequences(rows)))
