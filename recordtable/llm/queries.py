"""Registered queries of the training-data operators, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.llm import credentials as op8
from recordtable.llm import decontaminate as op6
from recordtable.llm import exact_dedup as op3
from recordtable.llm import langid as op2
from recordtable.llm import licenses as op7
from recordtable.llm import linededup as op1
from recordtable.llm import manifest as op13
from recordtable.llm import packing as op4
from recordtable.llm import sharding as op9
from recordtable.llm import simhash as op10
from recordtable.llm import tokencount as op11
from recordtable.llm import trie as op12
from recordtable.llm import urlfilter as op5
from recordtable.llm.common import join_hot, read_table, stage


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1.dedup_lines(read_table(spark, sf_dir, "documents")).drop("row_key")


def held_out() -> Column:
    """Documents that language identification must not learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def q_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    judged = op2.identify(docs, training=~held_out())
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def q_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    whole = {"text_sha256": F.sha2("text", 256)}
    return op3.exact_dedup(docs, carry=whole).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL_EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


#: Path of the tokenizer file; the same on the driver and the executors.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    packed = op4.pack_documents(docs, VOCABULARY, carry={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


URL_RULES = (
    op5.Rule("allow", "org/"),
    op5.Rule("block", "example.org/es/"),
    op5.Rule("block", "example.org/en/1"),
    op5.Rule("allow", "com/fr/"),
    op5.Rule("block", "com/de/"),
)


def q_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.judge_urls(read_table(spark, sf_dir, "pages"), URL_RULES)


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = op6.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return leaks.drop("row_key")


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op7.scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replaced_sql(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(by.replace('$', chr(92)))}, 'g')"


def _canonical_sql(text: str) -> str:
    out = _replaced_sql(_replaced_sql(f"lower({text})", *op7.COPYRIGHT_SENTENCE), *op7.COPYRIGHT_STATEMENT)
    out = f"replace({out}, {_quoted(op7.HELD)}, 'copyright')"
    for old, new in op7.SPELLINGS:
        out = f"replace({out}, {_quoted(old)}, {_quoted(new)})"
    for pattern, by in op7.WRAPPED_SPELLINGS:
        out = _replaced_sql(out, pattern, by)
    out = f"string_split(regexp_replace({out}, {_quoted(op7.NOT_WORD)}, ' ', 'g'), chr(10))"
    return f"[trim(x) FOR x IN {out} IF trim(x) <> '']"


SQL_LICENSES = f"""
WITH known(license_id, unit, text) AS (
    VALUES {", ".join("(" + ", ".join(map(_quoted, k)) + ")" for k in op7.known_licenses())}
),
digests AS (
    SELECT sha256(array_to_string({_canonical_sql("text")}, ' ')) AS digest, unit, min(license_id) AS license_id
    FROM known GROUP BY ALL
),
whole AS (SELECT digest, min(license_id) AS license_id FROM digests GROUP BY digest),
lines AS (SELECT doc_id, {_canonical_sql("coalesce(text, '')")} AS lines FROM documents),
each_line AS (SELECT DISTINCT doc_id, sha256(l) AS digest FROM (SELECT doc_id, unnest(lines) AS l FROM lines)),
named AS (
    SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
    FROM each_line JOIN digests USING (digest) WHERE unit = 'notice' GROUP BY doc_id
)
SELECT doc_id, d.digest, license_id, coalesce(notices, '') AS notices
FROM (SELECT doc_id, sha256(array_to_string(lines, ' ')) AS digest FROM lines) d
LEFT JOIN whole USING (digest) LEFT JOIN named USING (doc_id)
"""


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op8.scan_secrets(read_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        number = op8.KINDS.index(kind)
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    digest = F.sha2(op8.span_text(F.col("base")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, op8.span_text(F.col("spans")).alias("spans"))


def q_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = op9.shard(read_table(spark, sf_dir, "documents"))
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def q_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return op10.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def q_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.count_tokens(read_table(spark, sf_dir, "documents"), VOCABULARY)


def decimal_crc32(number: Column) -> Column:
    """CRC-32 of a whole number's decimal digits; null stays null."""
    return F.crc32(number.cast("string").cast("binary"))


def _crc32_sql(text: str) -> str:
    """DuckDB expression: CRC-32 of ASCII text."""
    byte = "list_reduce(range(8), lambda d, i: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384) ELSE d >> 1 END, xor(c, b))"
    codes = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: {byte}, 4294967295::BIGINT), 4294967295::BIGINT)"


def regrown(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, ids) of conversations that begin with the first turns of the one at the last multiple of 20 (``seq % 20`` before)."""

    def shared(seq: Column) -> Column:
        return decimal_crc32(seq) % 4

    base = F.col("seq") - F.col("seq") % 20
    lengths = turns.groupBy("seq").agg(F.count("*").alias("n"))
    heads = turns.where("depth <= 3").withColumnRenamed("seq", "base")
    grown = lengths.select("seq", base.alias("base"), shared(F.col("seq")).alias("h")).join(heads, "base").where("depth <= h")
    own = turns.withColumn("h", shared(F.col("seq"))).where("depth > h").withColumn("base", base)
    own = join_hot(own, lengths.withColumnRenamed("seq", "base"), "base", "left")
    before = F.least("h", F.coalesce("n", F.lit(0)))
    own = own.withColumn("depth", F.col("depth") - F.col("h") + before)
    return own.select(turns.columns).unionByName(grown.select(turns.columns)), lengths.select("seq")


def q_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(op12.turns(read_table(spark, sf_dir, "conversations")), "trie-turns")
    steps, ids = regrown(turns)
    return op12.prefix_trie(stage(steps, "trie-steps"), ids)


def q_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    tampered = F.when(decimal_crc32(F.col("doc_id")) % 7 == 0, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    checked = op13.manifest(docs, {"n_chars": tampered})

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    digests = [text(c).alias(c) for c in ("leaf", "subroot", "root")]
    return checked.select(
        "doc_id", *digests, F.sha2(text("proof"), 256).alias("proof_sha256"), text("folded_root").alias("folded_root"), "verified"
    )


def _leaf_sql(n_chars: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", f"({n_chars})::VARCHAR", "text"]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


SQL_TRIE = f"""
WITH turns AS (
    SELECT conv_id, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
           length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'), '[\x20\x09-\x0D]+', '', 'g')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, {_crc32_sql('conv_id::VARCHAR')} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)
),
rebuilt AS (
    SELECT c.conv_id, t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
    UNION ALL
    SELECT c.conv_id, 1000000 + t.pos, t.digest, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h
),
steps AS (
    SELECT conv_id, words, row_number() OVER own AS depth, string_agg(digest, '') OVER own AS prefix FROM rebuilt
    WINDOW own AS (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM convs
),
named AS (
    SELECT *, min(conv_id) OVER (PARTITION BY depth, prefix) AS name, max(depth) OVER (PARTITION BY conv_id) AS len FROM steps
),
nodes AS (
    SELECT name, depth, prefix, count(*) AS n_convs, (count(*) - 1) * max(words) AS own,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '')) AS ends_sha256
    FROM named GROUP BY name, depth, prefix
),
linked AS (
    SELECT n.*, p.name AS parent FROM nodes n LEFT JOIN named p ON p.conv_id = n.name AND p.depth = n.depth - 1
),
kids AS (
    SELECT n.*, (SELECT count(*) FROM linked k WHERE k.parent = n.name AND k.depth = n.depth + 1) AS n_children FROM linked n
),
totals AS (
    SELECT a.name, a.depth, sum(CASE WHEN d.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(d.own) AS saved
    FROM kids d JOIN named a ON a.conv_id = d.name AND a.depth <= d.depth GROUP BY a.name, a.depth
)
SELECT k.name AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, ends_sha256
FROM kids k JOIN totals USING (name, depth)
"""


SQL_MANIFEST = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf_sql("n_chars")} AS leaf,
           {_leaf_sql(f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS shown
    FROM documents
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY g) AS n
    FROM leaves
),
lower AS (
    SELECT g, 0 AS level, place, n, leaf AS h FROM placed
    UNION ALL
    SELECT g, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM lower WHERE n > 1 GROUP BY g, level, place // 2, n
),
tops AS (
    SELECT g, h AS subroot, row_number() OVER (ORDER BY encode(g)) - 1 AS place, count(*) OVER () AS n FROM lower WHERE n = 1
),
upper AS (
    SELECT 0 AS level, place, n, subroot AS h FROM tops
    UNION ALL
    SELECT level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM upper WHERE n > 1 GROUP BY level, place // 2, n
),
steps AS (
    SELECT p.g, p.place AS leaf_place, l.level, p.place >> l.level AS place, l.h
    FROM placed p JOIN lower l ON l.g = p.g AND l.n > 1 AND l.place // 2 = (p.place >> l.level) // 2 AND l.place <> p.place >> l.level
    UNION ALL
    SELECT p.g, p.place, 1000 + u.level, t.place >> u.level, u.h
    FROM placed p JOIN tops t USING (g)
    JOIN upper u ON u.n > 1 AND u.place // 2 = (t.place >> u.level) // 2 AND u.place <> t.place >> u.level
),
proofs AS (SELECT g, leaf_place AS place, string_agg(h, '' ORDER BY level) AS proof FROM steps GROUP BY ALL),
walk AS (
    SELECT p.g, p.place AS leaf_place, 0 AS level, p.place, p.n, p.shown AS h FROM placed p
    UNION ALL
    SELECT w.g, w.leaf_place, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 1000 END, CASE WHEN w.n > 1 THEN w.place // 2 ELSE t.place END,
           CASE WHEN w.n > 1 THEN (w.n + 1) // 2 ELSE t.n END,
           CASE WHEN w.n = 1 THEN w.h WHEN s.h IS NULL THEN sha256(w.h) WHEN w.place % 2 = 1 THEN sha256(s.h || w.h) ELSE sha256(w.h || s.h) END
    FROM walk w JOIN tops t USING (g)
    LEFT JOIN steps s ON s.g = w.g AND s.leaf_place = w.leaf_place AND s.level = w.level
    WHERE w.n > 1 OR w.level < 1000
)
SELECT p.doc_id, p.leaf, t.subroot, r.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, w.h AS folded_root, w.h = r.h AS verified
FROM placed p JOIN tops t USING (g) JOIN (SELECT h FROM upper WHERE n = 1) r ON true
JOIN (SELECT * FROM walk WHERE level >= 1000 AND n = 1) w ON w.g = p.g AND w.leaf_place = p.place
LEFT JOIN proofs x ON x.g = p.g AND x.place = p.place
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": q_line_dedup,
    "op2_language_id": q_language_id,
    "op3_exact_dedup": q_exact_dedup,
    "op4_packing": q_packing,
    "op5_url_filter": q_url_filter,
    "op6_decontamination": q_decontamination,
    "op7_licenses": q_licenses,
    "op8_secrets": q_secrets,
    "op9_sharding": q_sharding,
    "op10_simhash": q_simhash,
    "op11_token_counts": q_token_counts,
    "op12_conversation_trie": q_trie,
    "op13_manifest": q_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": SQL_EXACT_DEDUP,
    "op7_licenses": SQL_LICENSES,
    "op12_conversation_trie": SQL_TRIE,
    "op13_manifest": SQL_MANIFEST,
}
