"""Corpus preparation: language ID, exact dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but
the last keep the columns of ``docs``. Rows are removed by a bounded filter
plus an anti-join on the rows it lets through, so kept texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.llm import decontaminate, exact_dedup, langid, packing, simhash
from recordtable.llm.common import read_table, stage
from recordtable.llm.queries import VOCABULARY, held_out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; rejected ones (no letters, or far from every language) go."""
    return langid.drop_unidentified(docs, training=~held_out())


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of the largest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 3 bits), the one of the smallest id."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_distance=3)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark passage."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 1024 tokens."""
    packed = packing.pack_documents(docs, VOCABULARY, carry={"ids_crc32": F.crc32("ids")})
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark_leaks),
    ("best_fit_packing", sequences),
]

#: SQL cannot express fingerprints, centroids and packing; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
