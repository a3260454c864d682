"""The registered queries: SQL twins, result columns, and the pipeline against its parts in plain Python."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from cases import SF_ORACLE, SF_SMALL
from oracle import compare, duck
from test_simhash import near_roots, slow_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from recordtable.llm.decontaminate import OUTER, WINDOW
from recordtable.llm.queries import ORACLE_SQL, QUERIES

COLUMNS = {
    "op1_line_dedup": "doc_id line_no keep_id keep_line kept",
    "op2_language_id": "doc_id held_out lang_pred score rejected",
    "op3_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op4_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op5_url_filter": "page_id host path rule verdict score",
    "op6_decontamination": "doc_id item_id matched_windows first_token changed",
    "op7_licenses": "doc_id digest license_id notices",
    "op8_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_simhash": "doc_id fingerprint component_id",
    "op11_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op12_conversation_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op13_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
}


def test_registered():
    assert set(COLUMNS) == set(QUERIES) and set(ORACLE_SQL) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert "pipeline" not in E.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql_twin(spark, name):
    r = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE_SQL[name])
    assert r["values_match"] and r["rows_spark"], r


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(ORACLE_SQL) - {"op2_language_id", "op5_url_filter", "op1_line_dedup"}))
def test_columns(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name].split()
    assert df.count() > 0


def test_secret_digests(spark):
    rows = QUERIES["op8_secrets"](spark, SF_SMALL).collect()
    for r in rows:
        base = [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert r.n_assign + r.n_access + r.n_hex == len(base)
    assert sum(r.n_assign + r.n_access + r.n_hex for r in rows)


def test_pipeline(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing"
    ]
    first = stages[0][1](spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)
    assert first.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    left = {r.doc_id for r in first.select("doc_id").collect()}
    assert len(left) >= 0.99 * len(docs)
    # exact copies: the largest id stays
    by_text = defaultdict(list)
    for i in left:
        by_text[docs[i].text or ""].append(i)
    left = {max(ids) for ids in by_text.values()}
    # near copies: the smallest id stays
    prints = {i: slow_fingerprint(docs[i].text) for i in left}
    root, groups = near_roots(prints.values()), defaultdict(list)
    for i, fp in prints.items():
        groups[root[fp]].append(i)
    left = {min(ids) for ids in groups.values()}

    def words(text):
        return [w.strip(OUTER).lower() for w in (text or "").split() if w.strip(OUTER)]

    known = set()
    for item in items:
        w = words(item.text)
        known |= {tuple(w[i : i + WINDOW]) for i in range(len(w) - WINDOW + 1)}
    left = {i for i in left if not any(tuple(words(docs[i].text)[j : j + WINDOW]) in known for j in range(len(words(docs[i].text)) - WINDOW + 1))}

    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == left
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    at = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        ids = np.array([*tokenizer.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids, 2], "<u4")
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        assert at[r.sequence_id] == r.offset
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 1024
    assert sum(at.values()) == sum(len(tokenizer.encode(docs[i].text or "", add_special_tokens=False).ids) + 1 for i in left)
