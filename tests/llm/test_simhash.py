"""SimHash near-dedup against fingerprints and links computed one by one."""

import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import SF_SMALL, awkward, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from unionfind import roots

from recordtable.llm import simhash as S


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet=st.sampled_from("aAbZéÉ \t\n\x0b\x1c .x"), max_size=60))
def test_fingerprint(text):
    assert S.fingerprint(text) == slow_fingerprint(text)


def test_golay_code_is_perfect():
    # every word decodes, and decoding is unchanged by up to 3 errors on a codeword
    assert np.bincount(S.golay_index(np.arange(1 << 23, dtype=np.uint32))).tolist() == [1 << 11] * (1 << 12)
    rng = np.random.default_rng(1)
    _, high = S._golay_tables()
    message = rng.integers(0, 1 << 12, 500, dtype=np.uint32)
    code = message << np.uint32(11) | high[message]
    for k in range(4):
        noisy = code.copy()
        for i in range(len(noisy)):
            for b in rng.choice(23, k, replace=False):
                noisy[i] ^= np.uint32(1 << int(b))
        assert (S.golay_index(noisy) == message).all()


@settings(deadline=None, max_examples=200)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3))
def test_near_fingerprints_share_a_key(fp, flips):
    other = fp
    for b in flips:
        other ^= 1 << b
    keys = [set(S.fuzzy_keys(np.array([x], dtype=np.uint64))[1].tolist()) for x in (fp, other)]
    assert keys[0] & keys[1]
    assert all(len(k) <= 48 for k in keys)


def near_roots(fps, most=3):
    u = np.array(sorted(set(fps)), dtype=np.uint64)
    links = [(int(u[i]), int(u[j])) for i in range(len(u)) for j in range(i + 1, len(u)) if int(u[i] ^ u[j]).bit_count() <= most]
    return roots([int(x) for x in u], links)


@pytest.mark.parametrize("block", [2, 30, 4096])
def test_hot_keys_in_blocks(spark, block):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    fps = set()
    for i in range(260):
        x = int(centre[i % 3])
        for b in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(b)
        fps.add(x)
    signed = [(int(np.array(x, dtype=np.uint64).view(np.int64)),) for x in fps]
    df = spark.createDataFrame(signed, "fp long")
    got = [(r.a % 2**64, r.b % 2**64) for r in S.fingerprint_links(df, block=block).collect()]
    assert roots([int(x) for x in fps], got) == near_roots(fps)


def test_awkward_rows(spark, awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    component = near_roots([slow_fingerprint(t) for _, t in rows])
    least = {}
    for i, t in rows:
        c = component[slow_fingerprint(t)]
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = Counter((i, f"{slow_fingerprint(t):016x}", least.get(component[slow_fingerprint(t)])) for i, t in rows)
    got = S.near_duplicates(awkward).select("doc_id", "fingerprint", "component_id").collect()
    assert Counter(map(tuple, got)) == want


def test_drop(spark, awkward):
    left = S.drop_near_duplicates(awkward)
    assert left.columns == awkward.columns
    rows = left.collect()
    assert Counter(r.doc_id for r in rows) == Counter([1, 2, 4, 7, 8, None, 9, 10, 11])
    assert S.drop_near_duplicates(awkward.limit(0)).count() == 0


def test_drop_keeps_a_row_of_each_component(spark):
    rows = [
        (None, "one text without an id about the weather in spring"),
        (None, "something else entirely, on ships and harbours, without an id"),
        (None, "something else entirely, on ships and harbours, without an id"),
        (5, "a text under a repeated id that tells of mountains"),
        (5, "quite another one under that id, which lists kinds of bread"),
        (None, "a text under a repeated id that tells of mountains"),
    ]
    left = S.drop_near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert Counter(map(tuple, left)) == Counter([rows[0], rows[1], rows[3], rows[4]])


def test_empty(spark, nothing):
    assert S.near_duplicates(nothing).count() == 0


def test_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    component = near_roots([slow_fingerprint(t) for _, t in rows])
    least = {}
    for i, t in rows:
        c = component[slow_fingerprint(t)]
        least[c] = min(least.get(c, i), i)
    want = {(i, f"{slow_fingerprint(t):016x}", least[component[slow_fingerprint(t)]]) for i, t in rows}
    got = S.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
