"""One huge JSON text as many rows: its elements, cut in parallel by byte ranges.

The file is read with a comma as line separator, so Spark deals its byte
ranges over tasks and no row holds more than the text between two commas.
Which commas separate elements is known only from the start of the file on:
they are outside strings and one level deep. So the file is read twice.

1. *Effects*. Each split says what it does to a reader who enters it outside
   a string, and to one who enters it inside: change of depth, quotes seen,
   and how many of its commas lie at each depth. That is all a split needs to
   say; it is some 100 bytes. A running sum over the splits of a file then
   gives the state in which each is entered and the number of its first element.
2. *Elements*. Each split, entered in its true state, is cut at its
   top-level commas. Elements inside a split are whole; the first and last
   of a split may go on in its neighbours, and only those are shuffled.

A backslash needs no state of its own: it may stand before a comma only in
broken JSON, and a comma changes no state.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordtable.operators.joins import DEFAULT_MAX_BROADCAST_ROWS, bounded_rows
from recordtable.sources.sinks import stage

_EFFECTS = "file string, block long, root int, quotes long, depth0 long, depth1 long, commas0 map<long,long>, commas1 map<long,long>"
_ELEMENTS = "file string, pos long, block long, whole boolean, text string"


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """Texts between commas, with the file and the split that they are from."""
    df = spark.read.option("lineSep", ",").text(path)
    return df.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


_QUOTE, _BACKSLASH, _OPEN, _CLOSE = 1, 2, 3, 4
_KINDS = np.zeros(256, np.uint8)
for _chars, _kind in ((b'"', _QUOTE), (b"\\", _BACKSLASH), (b"[{", _OPEN), (b"]}", _CLOSE)):
    _KINDS[list(_chars)] = _kind


def _texts(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("value").cast(pa.string())


def _scan(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: quotes in it, and change of depth if entered outside (0) and inside (1) a string.

    A backslash takes the character behind it along, inside a text only.
    """
    n = len(texts)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets -= offsets[0]
    kinds = _KINDS[raw]
    slashes = np.flatnonzero(kinds == _BACKSLASH)
    if len(slashes):
        text = np.searchsorted(offsets, slashes, "right")
        new = np.r_[True, (slashes[1:] != slashes[:-1] + 1) | (text[1:] != text[:-1])]
        starts = np.flatnonzero(new)
        lengths = np.diff(np.r_[starts, len(slashes)])
        behind = slashes[starts] + lengths
        taken = behind[(lengths % 2 == 1) & (behind < offsets[text[starts]])]
        kinds[slashes] = 0
        kinds[taken] = 0
    at = np.flatnonzero(kinds)
    kind, bounds = kinds[at], np.searchsorted(at, offsets)
    quotes = np.r_[0, np.cumsum(kind == _QUOTE)]
    first = np.repeat(quotes[bounds[:-1]], np.diff(bounds))
    odd = (quotes[:-1] - first) & 1
    change = (kind == _OPEN).astype(np.int64) - (kind == _CLOSE)
    depth0, depth1 = np.r_[0, np.cumsum(change * (1 - odd))], np.r_[0, np.cumsum(change * odd)]
    return tuple(np.diff(c[bounds]) for c in (quotes, depth0, depth1))


def _root(text: str) -> int:
    """First character that is no white space: 91 or 123 where it opens a root that holds many, else 0."""
    start = text.lstrip(" \t\n\x0b\f\r")[:1]
    return ord(start) if start in ("[", "{") else 0


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """``(file, block), from, to`` of the rows of each split in a batch; a split's rows stand together."""
    if not batch.num_rows:
        return
    files = batch.column("file").dictionary_encode()
    codes, blocks = files.indices.to_numpy(), batch.column("block").to_numpy()
    new = np.flatnonzero((codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1])) + 1
    bounds = [0, *new.tolist(), batch.num_rows]
    for lo, hi in zip(bounds, bounds[1:]):
        yield (files.dictionary[codes[lo]].as_py(), int(blocks[lo])), lo, hi


def _before(changes: np.ndarray, start: int) -> np.ndarray:
    """Running sum before each element."""
    return start + np.cumsum(changes) - changes


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split, see :data:`_EFFECTS`; ``commas``: number of fragments outside strings by depth before them."""
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("root", pa.int32()), ("quotes", pa.int64()),
        ("depth0", pa.int64()), ("depth1", pa.int64()),
        ("commas0", pa.map_(pa.int64(), pa.int64())), ("commas1", pa.map_(pa.int64(), pa.int64())),
    ])

    def row(split, root, quotes, depth, commas):
        values = [*split, root, quotes, *depth, *[list(c.items()) for c in commas]]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    split, root, quotes, depth, commas = None, 0, 0, [0, 0], (Counter(), Counter())
    for batch in batches:
        texts = _texts(batch)
        for this, lo, hi in _runs(batch):
            if this != split:
                if split:
                    yield row(split, root, quotes, depth, commas)
                root = _root(texts[lo].as_py()) if this[1] == 0 else 0
                split, quotes, depth, commas = this, 0, [0, 0], (Counter(), Counter())
            seen, *changes = _scan(texts.slice(lo, hi - lo))
            for s in (0, 1):
                inside = (_before(seen, quotes + s) & 1).astype(bool)
                change = np.where(inside, changes[1], changes[0])
                levels, counts = np.unique(_before(change, depth[s])[~inside], return_counts=True)
                commas[s].update(dict(zip(levels.tolist(), counts.tolist())))
                depth[s] += int(change.sum())
            quotes += int(seen.sum())
    if split:
        yield row(split, root, quotes, depth, commas)


def _splits(effects: DataFrame) -> DataFrame:
    """State in which each split is entered (``inside`` a string, ``level``, number of elements begun) and left."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def running(c: Column) -> Column:
        return F.coalesce(F.sum(c).over(before), F.lit(0))

    df = effects.withColumn("inside", running(F.col("quotes")) % 2)
    df = df.withColumn("change", F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1")))
    df = df.withColumn("level", running(F.col("change")))
    commas = F.when(F.col("inside") == 0, F.col("commas0")).otherwise(F.col("commas1"))
    # a fragment that starts one level deep, outside strings, starts an element
    df = df.withColumn("cuts", F.coalesce(F.try_element_at(commas, F.lit(1) - F.col("level")), F.lit(0)))
    return df.select("file", "block", "root", "quotes", "inside", "level", "change", "cuts", running(F.col("cuts")).alias("begun"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Elements of each split, see :data:`_ELEMENTS`; ``whole`` is false for its first and last, which may go on elsewhere."""
    schema = pa.schema([
        ("file", pa.string()), ("pos", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("text", pa.string()),
    ])
    split, quotes, depth, pos, parts, started = None, 0, 0, 0, [], False

    def rows(pos, whole, texts):
        values = [pa.repeat(split[0], len(texts)), np.arange(pos, pos + len(texts)), np.full(len(texts), split[1]), whole, texts]
        return pa.record_batch([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)

    def joined():
        return [",".join(t for p in parts for t in p.to_pylist())]

    for batch in batches:
        texts = _texts(batch)
        for this, lo, hi in _runs(batch):
            if this != split:
                if parts:
                    yield rows(pos, [False], joined())
                split, parts, started = this, [], False
                quotes, depth, pos = (batch.column(c)[lo].as_py() for c in ("inside", "level", "begun"))
            own = texts.slice(lo, hi - lo)
            seen, outside, after = _scan(own)
            inside = (_before(seen, quotes) & 1).astype(bool)
            change = np.where(inside, after, outside)
            cuts = np.flatnonzero((_before(change, depth) == 1) & ~inside)
            quotes, depth = quotes + int(seen.sum()), depth + int(change.sum())
            if not len(cuts):
                parts.append(own)
                continue
            if cuts[0]:
                parts.append(own.slice(0, cuts[0]))
            if parts:
                yield rows(pos, [started], joined())
            between = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), own)
            if len(between):
                yield rows(pos + 1, np.ones(len(between), bool), pc.binary_join(between, ","))
            parts, started, pos = [own.slice(cuts[-1])], True, pos + len(cuts)
    if parts:
        yield rows(pos, [False], joined())


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if bounded_rows(df, DEFAULT_MAX_BROADCAST_ROWS) is not None else df


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Elements of JSON files, each one array or one object of values -> ``(source_file, pos, element)``.

    ``pos`` counts the elements of a file from 0; ``element`` is its JSON text
    (of a root object: of the value). Files are cut in byte ranges
    (``spark.sql.files.maxPartitionBytes``), so a file may be larger than any
    task's memory; an element may not. An uncompressed file is read twice, its
    elements are written once under ``spark.checkpoint.dir``; of texts only
    the two pieces at the ends of a split are shuffled. A compressed file is one split.

    Broken JSON costs only the elements it touches: their text does not
    parse. A file that ends before its root is closed is cut off; one more
    element ``[`` says so, as no JSON text. Empty files and empty roots give
    no rows; a scalar root is one element.
    """
    fragments = _fragments(spark, path)
    effects = fragments.mapInArrow(_effects, _EFFECTS)
    splits = stage(_splits(effects), "json-splits")
    entered = fragments.join(_small(splits.select("file", "block", "inside", "level", "begun")), ["file", "block"])
    cut = stage(entered.mapInArrow(_cut, _ELEMENTS), "json-elements")

    pieces = F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda p: p["text"])
    joined = cut.where(~F.col("whole")).groupBy("file", "pos").agg(F.array_join(pieces, ",").alias("text"))
    elements = cut.where("whole").select("file", "pos", "text").unionByName(joined)

    files = stage(splits.groupBy("file").agg(
        F.char(F.max("root").cast("long")).alias("root"),
        F.sum("cuts").alias("last"),
        ((F.sum("change") == 0) & (F.sum("quotes") % 2 == 0)).alias("closed"),
    ), "json-files")
    holds_many = F.col("root").isin("[", "{")
    text = F.when(holds_many & (F.col("pos") == 0), F.regexp_replace("text", r"\A\s*+[\[{]", "")).otherwise(F.col("text"))
    text = F.when(holds_many & F.col("closed") & (F.col("pos") == F.col("last")), F.regexp_replace(text, r"[\]}]\s*\z", "")).otherwise(text)
    out = elements.join(_small(files), "file").withColumn("text", text)
    out = out.where(~((F.col("last") == 0) & F.col("text").rlike(r"\A\s*+\z")))
    value = F.regexp_replace("text", r'(?s)\A\s*+"(?:[^"\\]++|\\.)*+"\s*+:', "")
    element = F.when(F.col("root") == "{", value).otherwise(F.col("text"))
    cut_off = files.where(~F.col("closed")).select("file", (F.col("last") + 1).alias("pos"), F.lit("[").alias("element"))
    return out.select("file", "pos", element.alias("element")).unionByName(cut_off).withColumnRenamed("file", "source_file")
