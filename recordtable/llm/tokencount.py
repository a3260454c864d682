"""Token counts of whole texts by the whole-token shortcut.

Before the texts are read it is proved, for every string of the vocabulary,
whether its own merges end in that one token. The proved strings (at most as many
as the vocabulary has, about 1 MB here) are broadcast. In the tasks a text is
cut into pre-tokens; one that is a proved string counts one without
any merging, and only the others are merged, each by itself, with the
counts of recent ones remembered within a fixed bound.

One pass over the documents in Arrow batches, no shuffle; a text of
any length is counted pre-token by pre-token.

Defined results: null text counts as empty and has no tokens; special tokens
in a text count one each, as the library reads them by default; repeated rows
get a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtable.llm import bytebpe

LIMIT = 512

#: This Python process's encoders with their proved strings, by vocabulary.
_ENCODERS: dict[str, bytebpe.Encoder] = {}


def _counts(batches: Iterator[pa.RecordBatch], vocabulary: str, whole: list[str]) -> Iterator[pa.RecordBatch]:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = bytebpe.Encoder(vocabulary, whole)
    count = _ENCODERS[vocabulary].count
    for b in batches:
        n = [count(t.as_py()) for t in b.column("__text")]
        yield pa.record_batch({"__id": b.column("__id"), "n_bytes": b.column("__size"), "n_tokens": pa.array(n, pa.int64())})


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``<id_col>, n_bytes, n_tokens, over_limit``.

    ``vocabulary``: path of a byte-level BPE ``tokenizer.json``, the same on the driver and the executors.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), text.alias("__text"), F.octet_length(text).cast("long").alias("__size"))
    id_type = rows.schema["__id"].dataType.simpleString()
    whole = docs.sparkSession.sparkContext.broadcast(bytebpe.whole_tokens(vocabulary))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counts(batches, vocabulary, whole.value)

    counted = rows.mapInArrow(counts, f"__id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
