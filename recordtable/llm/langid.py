"""Language identification by nearest centroids of TF-IDF byte n-gram vectors.

A text is lower-cased, runs of ASCII characters other than letters become one space
(characters beyond ASCII all stay), and its byte
trigrams (of UTF-8, so accents count) are hashed to ``DIMENSIONS`` features.
A document's vector is (1 + ln count) * idf, normalised to length 1. Each
language has up to ``CENTROIDS`` centroids, clustered by spherical k-means;
the language of the centroid with the largest cosine is predicted, with that
cosine as score.

Rejection by distance: for each language and size class (power of two of the
number of different features) the limit is ``REJECT_SHARE`` of the 1 %
quantile of the scores that correctly predicted training documents get, so a
document is rejected only if it is far beyond its kind. Where fewer than
``REJECT_ROWS`` training documents fell, the limit is ``REJECT_FLOOR`` (hardly
a common n-gram with any centroid) for texts of 8 different features or more,
and none for shorter ones. Texts without letters are ``und`` and rejected.

What covers what: document frequencies and the rejection quantiles are taken
over all training documents; only the clustering is fitted on a sample, of
``SAMPLE_PER_LANGUAGE`` (400) different texts per language: exactly those of the
smallest hashes of the text, so neither ids nor copies nor the order of rows
matter. A language's sample is clustered in one task (400 vectors at most). The frequencies
(at most ``DIMENSIONS`` numbers), the labels (at most ``MAX_LABELS``) and their centroids are
all that reaches the driver; the model is broadcast.

Defined results: null text or one without letters: ``und``, score 0; ties go
to the alphabetically first language; no usable labels at all: every text is
``und`` with score 0 and only texts without letters are rejected; repeated
rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import remove_rows, row_key, stage

DIMENSIONS = 1 << 14
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 400
MAX_LABELS = 1000
REJECT_SHARE = 0.5
REJECT_QUANTILE = 0.01
REJECT_ROWS = 30
REJECT_FLOOR = 0.02
UNKNOWN = "und"

#: ASCII letters (lower-cased before) and the bytes of all other characters stay, the rest are spaces.
_KEEP = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, counts) of a whole text; empty if it has no letter."""
    if not text or not (text.isalpha() or any(map(str.isalpha, text))):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    raw = text.lower().encode("utf-8", "surrogatepass").translate(_KEEP)
    b = np.frombuffer(b" " + raw + b" ", dtype=np.uint8)
    stays = b != 32
    stays[1:] |= b[:-1] != 32  # of a run of spaces the first
    stays[0] = True
    b = b[stays].astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
    code = (code * np.uint32(0x9E3779B1)) >> np.uint32(18)  # 14 bits
    count = np.bincount(code, minlength=DIMENSIONS)
    number = np.nonzero(count)[0]
    return number, count[number]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: number of documents that have each feature, and under -1 the number of documents."""
    seen, rows = np.zeros(DIMENSIONS, dtype=np.int64), 0
    for b in batches:
        for t in b.column("__text"):
            number, _ = features(t.as_py())
            seen[number] += 1
            rows += len(number) > 0
    number = np.nonzero(seen)[0]
    yield pa.record_batch(
        {"feature": pa.array([-1, *number.tolist()], pa.int32()), "n": pa.array([rows, *seen[number].tolist()], pa.int64())}
    )


@dataclass(frozen=True)
class Model:
    """Centroids as columns of ``weight`` (idf already applied), each column's label, and the idf."""

    labels: tuple[str, ...]
    weight: np.ndarray
    idf: np.ndarray

    def scores(self, number: np.ndarray, count: np.ndarray) -> np.ndarray:
        tf = (1 + np.log(count)).astype(np.float32)
        norm = float(np.linalg.norm(tf * self.idf[number])) or 1.0
        return tf @ self.weight[number] / norm


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit rows; starts from the mean's nearest row and then each time the farthest row."""
    start = [int((x @ x.mean(axis=0)).argmax())]
    near = x @ x[start[0]]
    while len(start) < min(k, len(x)):
        start.append(int(near.argmin()))
        near = np.maximum(near, x @ x[start[-1]])
    centre = x[start]
    for _ in range(rounds):
        own = (x @ centre.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centre[j] for j in range(len(centre))])
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centre


def _centroids(table: pa.Table, idf: np.ndarray) -> pa.Table:
    """Centroids, weighted by idf, of one language's texts."""
    found = [features(t.as_py()) for t in table.column("text")]
    # the order of arrival must not matter
    found = sorted((f for f in found if len(f[0])), key=lambda f: (f[0].tobytes(), f[1].tobytes()))
    x = np.zeros((len(found), DIMENSIONS), dtype=np.float32)
    for i, (number, count) in enumerate(found):
        x[i, number] = (1 + np.log(count)) * idf[number]
    if not len(x):
        return pa.table({"label": pa.array([], pa.string()), "centroid": pa.array([], pa.int32()), "weight": pa.array([], pa.binary())})
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centre = (cluster(x, CENTROIDS) * idf).astype("<f4")
    return pa.table(
        {
            "label": pa.array([table.column("label")[0].as_py()] * len(centre), pa.string()),
            "centroid": pa.array(range(len(centre)), pa.int32()),
            "weight": pa.array([c.tobytes() for c in centre], pa.binary()),
        }
    )


def fit(training: DataFrame, text_col: str, label_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Model of the labelled rows of ``training``; None if there are none with letters."""
    labelled = training.where(F.col(label_col).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(label_col).count().limit(MAX_LABELS + 1).collect()}
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"over {MAX_LABELS} labels")
    if not sizes:
        return None
    texts = labelled.select(F.col(text_col).alias("__text"))
    counted = texts.mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequency = counted.toPandas()
    rows = int(frequency.loc[frequency["feature"] == -1, "n"].sum())
    frequency = frequency[frequency["feature"] >= 0]
    # a feature that no training document has counts as rarest: foreign text is far from every centroid
    idf = np.full(DIMENSIONS, np.log(1 + rows) + 1, dtype=np.float32)
    idf[frequency["feature"].to_numpy()] = np.log((1 + rows) / (1 + frequency["n"].to_numpy())) + 1

    hashed = F.xxhash64(F.col(text_col), F.lit("sample"))
    lettered = labelled.where(F.col(text_col).rlike("\\p{L}")).select(
        F.col(label_col).alias("label"), hashed.alias("h"), F.col(text_col).alias("text")
    )
    # the rank limit is applied in every task before rows are exchanged
    least = Window.partitionBy("label").orderBy("h")
    chosen = lettered.select("label", "h").distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= per_language)
    # at most MAX_LABELS * per_language hashes
    sample = lettered.join(F.broadcast(chosen.select("label", "h")), ["label", "h"]).groupBy("label", "h").agg(F.min("text").alias("text"))
    found = sample.select("label", "text").groupBy("label").applyInArrow(
        lambda table: _centroids(table, idf), "label string, centroid int, weight binary"
    )
    centroids = found.toPandas().sort_values(["label", "centroid"])
    labels = centroids["label"].tolist()
    weights = [np.frombuffer(w, "<f4") for w in centroids["weight"]]
    if not labels:
        return None
    return Model(tuple(labels), np.ascontiguousarray(np.stack(weights).T), idf)


def _predict(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for b in batches:
        label, score, size = [], [], []
        for t in b.column("__text"):
            number, count = features(t.as_py())
            size.append(len(number))
            if model is None or not len(number):
                label.append(UNKNOWN)
                score.append(0.0)
                continue
            s = model.scores(number, count)
            best = int(s.argmax())  # the first of equals; labels are in order
            label.append(model.labels[best])
            score.append(min(1.0, max(0.0, float(s[best]))))
        yield pa.record_batch(
            {
                "__row": b.column("__row"),
                "lang_pred": pa.array(label, pa.string()),
                "score": pa.array(score, pa.float64()),
                "features": pa.array(size, pa.int32()),
            }
        )


def identify(
    docs: DataFrame,
    training: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> DataFrame:
    """One row per input row: ``<id_col>, lang_pred, score, rejected, row_key``.

    ``training``: condition on the rows that may be learned from (all by default).
    """
    training = F.lit(True) if training is None else F.coalesce(training, F.lit(False))
    model = fit(docs.where(training), text_col, label_col, per_language)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.struct(
            F.col(id_col).alias("id"),
            row_key(docs, id_col, text_col).alias("key"),
            F.when(training, F.col(label_col)).alias("label"),
        ).alias("__row"),
        F.col(text_col).alias("__text"),
    )
    kind = rows.schema["__row"].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _predict(batches, sent.value)

    out = rows.mapInArrow(predict, f"__row {kind}, lang_pred string, score double, features int")
    out = out.select("__row.*", "lang_pred", "score", F.length(F.bin("features")).alias("size_class"), "features")
    out = stage(out, "langid-scores")
    limits = (
        out.where("label = lang_pred and features > 0")
        .groupBy("lang_pred", "size_class")
        .agg(F.percentile_approx("score", REJECT_QUANTILE, 1000).alias("low"), F.count("*").alias("n"))
        .where(F.col("n") >= REJECT_ROWS)
        .select("lang_pred", "size_class", (F.col("low") * REJECT_SHARE).alias("limit"))
    )
    # at most MAX_LABELS languages x 16 size classes
    judged = out.join(F.broadcast(limits), ["lang_pred", "size_class"], "left")
    floor = F.when(F.col("features") >= 8, REJECT_FLOOR if model else 0.0).otherwise(0.0)
    rejected = (F.col("features") == 0) | (F.col("score") < F.coalesce("limit", floor))
    return judged.select(F.col("id").alias(id_col), "lang_pred", "score", rejected.alias("rejected"), F.col("key").alias("row_key"))


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that language identification rejects; all columns stay."""
    judged = identify(docs, id_col=id_col, text_col=text_col, **options).where("rejected")
    removed = judged.select(F.col("row_key").alias("__key"), F.lit(0).alias("__keep")).distinct()
    return remove_rows(docs, stage(removed, "langid-removed"), id_col, text_col)
