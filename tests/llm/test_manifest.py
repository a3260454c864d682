"""Manifest against plain Python: leaves, roots, proofs and what tampered rows fold to."""

import hashlib
from collections import defaultdict

import pytest
from cases import SF_SMALL, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from recordtable.llm import manifest as M
from recordtable.llm.queries import QUERIES

NAMES = ["doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified", "place"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def slow_leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def slow_tree(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def slow_proof(tree, at, arity):
    proof, steps = [], []
    for level in tree[:-1]:
        first = at - at % arity
        run = level[first : first + arity]
        proof += run[: at - first] + run[at - first + 1 :]
        steps.append((run, at - first))
        at //= arity
    return proof, steps


def slow_fold(node, steps):
    for run, at in steps:
        node = h("".join([*run[:at], node, *run[at + 1 :]]))
    return node


def slow_manifest(rows, arity, shown=lambda r: r):
    """Sorted (doc_id, leaf, subroot, root, proof, folded, verified); rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0], slow_leaf(r), slow_leaf(shown(r))))
    trees, order = {}, sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = slow_tree([x[1] for x in groups[g]], arity)
    top = slow_tree([trees[g][-1][0] for g in order], arity)
    root, out = top[-1][0], []
    for i, g in enumerate(order):
        above, steps_above = slow_proof(top, i, arity)
        for at, (doc_id, leaf, presented) in enumerate(groups[g]):
            proof, steps = slow_proof(trees[g], at, arity)
            folded = slow_fold(presented, steps + steps_above)
            out.append((doc_id, leaf, trees[g][-1][0], root, "".join(proof + above), folded, folded == root))
    return sorted(out, key=str)


def result(df):
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "proof", "folded_root")]
    return sorted((tuple(r) for r in df.select("doc_id", *digests, "verified").collect()), key=str)


def values(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize(("arity", "slots"), [(2, 1024), (2, 4), (3, 9), (5, 5), (7, 3)])
def test_awkward(spark, awkward, monkeypatch, arity, slots):
    monkeypatch.setattr(M, "SLOTS", slots)
    shown = {"n_chars": F.when(F.col("doc_id") % 3 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    got = M.manifest(awkward, shown, arity=arity)
    assert got.columns == NAMES

    def tampered(r):
        return (*r[:3], r[3] + 1 if r[0] is not None and r[0] % 3 == 0 else r[3], r[4])

    assert result(got) == slow_manifest(values(awkward), arity, tampered)


def test_nothing(nothing):
    assert M.manifest(nothing).collect() == []


def test_ids_far_apart_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(M, "SLOTS", 16)
    far = [-(2**63), -(2**45) - 1, -70, -1, 0, 1, 62, 63, 64, 65, 4_000_000, 2**22 - 1, 2**22, 2**42 - 1, 2**42, 2**63 - 1]
    rows = [(i, "s", "en", 1, f"t{i}") for i in far]
    # a third of all rows has one id, a third none; some of them are equal
    rows += [(64, "s", "en", k % 5, f"copy {k % 40}") for k in range(100)]
    rows += [(None, "s", "en" if k % 3 else None, None, f"none {k % 30}") for k in range(100)]
    rows += [(i, None, "de", i, "x") for i in range(0, 200, 3)]
    rows += [(5, "s", "only one", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = M.manifest(docs)
    assert result(got) == slow_manifest(rows, 2)
    assert got.where("not verified").count() == 0


def test_one_group_has_no_upper_levels(spark):
    docs = spark.createDataFrame([(1, "s", "en", 1, "a")], "doc_id int, source string, lang string, n_chars long, text string")
    r = M.manifest(docs).collect()[0]
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof == b"" and r.verified
    assert M.manifest(docs).schema["doc_id"].dataType.simpleString() == "int"


def test_arity(nothing):
    with pytest.raises(ValueError):
        M.manifest(nothing, arity=1)


def test_table(spark):
    rows = QUERIES["op13_manifest"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    import zlib

    def shown(r):
        return (*r[:3], r[3] + 1 if r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else r[3], r[4])

    want = slow_manifest([(d.doc_id, d.source, d.lang, d.n_chars, d.text) for d in docs], 2, shown)
    want = [(i, leaf, sub, root, h(proof), folded, ok) for i, leaf, sub, root, proof, folded, ok in want]
    got = [tuple(r) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(not r.verified for r in rows) and any(r.verified for r in rows)
