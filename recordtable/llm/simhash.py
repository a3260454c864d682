"""SimHash near-dedup by Golay-code fuzzy hashing.

Fingerprint: 64 bits; bit ``i`` is set if it is set in more than half of the
XXH64 hashes (seed 42) of a document's shingles. Two documents are linked if
their fingerprints differ in at most ``max_distance`` (3) bits; a group is a
connected component.

Search. The 64 bits are cut into four quarters. With at most 3 errors one
quarter is free of errors, and of the two 24-bit halves of the other 48 bits
one has at most one error (pigeonhole). A half is read as a word of the
binary Golay code (23,12), which is perfect: each word has one codeword
within 3 bits. A half's keys are the indices of the codewords that the word
itself and its 23 one-bit neighbours decode to: 1 or 6 indices. Two halves
that differ in one bit (also in two, as they have a common neighbour) share a
key. So a linked pair shares at least one of its 8 sets of keys
(quarter number, half, quarter's value, codeword index), 28 bits each plus the
set's number, and every pair within a key is verified on all 64 bits.

Copies of a fingerprint are joined before the search, so a large group of
exact copies costs one entry. Within a key, tasks return the links of a
spanning forest only, never all pairs. A key with more than ``block`` entries
is cut into blocks; each pair of blocks is a task's work of bounded size.

Defined results: null text counts as empty, a text without words has
fingerprint zero, which links like any other. Fewer words than the shingle
length give one shingle of them all. A null id takes part in linking but is
no ``component_id`` unless all ids of the component are null. Repeated rows
each get a row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, remove_rows, row_key, stage
from recordtable.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
#: Entries of a key compared in one task's work; larger keys are cut into blocks of about this size.
BLOCK = 4096

# Generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 of the binary Golay code (23,12).
GOLAY_POLYNOMIAL = 0b110001110101
GOLAY_BITS, GOLAY_CHECK_BITS = 23, 11


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a whole text, as an unsigned 64-bit integer."""
    # bytes.lower() changes A-Z only; bytes.split() splits at 0x20 and 0x09-0x0D
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) <= words:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False))
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 14):  # a bounded block of bits at a time
        part = np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp = np.array([fingerprint(t.as_py(), words, seed) for t in b.column("__text")], dtype=np.uint64)
        yield pa.record_batch({"__row": b.column("__row"), "fp": pa.array(fp.view(np.int64))})


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """(error pattern by syndrome, syndrome by 23-bit word's high 12 bits): decoding is two lookups."""
    if not _tables:
        _tables.append(_make_golay_tables())
    return _tables[0]


def _make_golay_tables() -> tuple[np.ndarray, np.ndarray]:

    def remainder(word: int) -> int:
        for i in range(GOLAY_BITS - 1, GOLAY_CHECK_BITS - 1, -1):
            if word >> i & 1:
                word ^= GOLAY_POLYNOMIAL << (i - GOLAY_CHECK_BITS)
        return word

    units = [remainder(1 << i) for i in range(GOLAY_BITS)]
    error = np.zeros(1 << GOLAY_CHECK_BITS, dtype=np.uint32)
    for i in range(GOLAY_BITS):
        for j in range(i, GOLAY_BITS):
            for k in range(j, GOLAY_BITS):
                bits = {i, j, k}
                syndrome = 0
                for x in bits:
                    syndrome ^= units[x]
                error[syndrome] = sum(1 << x for x in bits)
    high = np.array([remainder(m << GOLAY_CHECK_BITS) for m in range(1 << 12)], dtype=np.uint32)
    return error, high


def golay_index(word: np.ndarray) -> np.ndarray:
    """12-bit message index of the codeword nearest to each 23-bit word (at most 3 bits away)."""
    error, high = _golay_tables()
    low = word & ((1 << GOLAY_CHECK_BITS) - 1)
    return (word ^ error[high[word >> GOLAY_CHECK_BITS] ^ low]) >> GOLAY_CHECK_BITS


def nearby_indices(word: np.ndarray) -> np.ndarray:
    """(n, 24) indices that the words and their one-bit neighbours decode to (with repeats)."""
    flips = np.array([0, *(1 << i for i in range(GOLAY_BITS))], dtype=np.uint32)
    return golay_index(word[:, None] ^ flips[None, :])


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position in fp, key) of all fuzzy keys of the fingerprints, each key once for a fingerprint."""
    fp = fp.astype(np.uint64)
    quarters = [((fp >> np.uint64(16 * i)) & np.uint64(0xFFFF)) for i in range(4)]
    at, keys = [], []
    for i in range(4):
        rest = [q for j, q in enumerate(quarters) if j != i]
        bits48 = rest[0] | rest[1] << np.uint64(16) | rest[2] << np.uint64(32)
        for half in range(2):
            word = ((bits48 >> np.uint64(24 * half)) & np.uint64((1 << GOLAY_BITS) - 1)).astype(np.uint32)
            index = np.sort(nearby_indices(word), axis=1)
            first = np.ones(index.shape, dtype=bool)
            first[:, 1:] = index[:, 1:] != index[:, :-1]
            row, col = np.nonzero(first)
            at.append(row)
            head = quarters[i][row] << np.uint64(12) | np.uint64(i * 2 + half) << np.uint64(28)
            keys.append(head | index[row, col].astype(np.uint64))
    return np.concatenate(at), np.concatenate(keys).astype(np.int64)


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        values = b.column("fp").to_numpy()
        for i in range(0, len(values), 4096):
            fp = values[i : i + 4096]
            at, key = fuzzy_keys(fp.view(np.uint64))
            yield pa.record_batch({"key": pa.array(key), "fp": pa.array(fp[at])})


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= most


def _forest(fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of ``fp`` under distance <= most: each entry is met once from a found one."""
    left = np.ones(len(fp), dtype=bool)
    a: list[np.ndarray] = []
    b: list[np.ndarray] = []
    for start in range(len(fp)):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            at = todo.pop()
            rest = np.nonzero(left)[0]
            new = rest[_near(fp[rest], fp[at], most)]
            left[new] = False
            todo.extend(new.tolist())
            a.append(np.full(len(new), fp[at]))
            b.append(fp[new])
    return np.concatenate(a), np.concatenate(b)


SMALL_RUN = 48


def _run_links(run: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``run``: all of them in small runs, a spanning forest in others."""
    start = np.ones(len(fp), dtype=bool)
    start[1:] = run[1:] != run[:-1]
    number = np.cumsum(start) - 1
    size = np.bincount(number)
    first = np.nonzero(start)[0]
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    small = size[number] <= SMALL_RUN
    for d in range(1, min(int(size.max(initial=0)), SMALL_RUN)):  # neighbours d places on, all runs at once
        i = np.nonzero(small[:-d] & (number[d:] == number[:-d]))[0]
        i = i[_near(fp[i], fp[i + d], most)]
        a.append(fp[i])
        b.append(fp[i + d])
    for g in np.nonzero(size > SMALL_RUN)[0]:
        x, y = _forest(np.unique(fp[first[g] : first[g] + size[g]]), most)
        a.append(x)
        b.append(y)
    x, y = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.maximum(x, y), np.minimum(x, y)]), axis=1)
    return pairs[0].view(np.int64), pairs[1].view(np.int64)


def _links(batches: Iterator[pa.RecordBatch], most: int, longest: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``run``: links (hot false); runs over ``longest`` come out as they are (hot true: run, fp).

    Holds one Arrow batch and one run of at most ``longest`` rows.
    """

    def out(hot: bool, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"hot": pa.array(np.full(len(a), hot)), "a": pa.array(a), "b": pa.array(b)})

    def done(run: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, number, size = np.unique(run, return_inverse=True, return_counts=True)
        long = size[number] > longest
        if long.any():
            yield out(True, run[long], fp[long])
        if not long.all():
            yield out(False, *_run_links(run[~long], fp[~long].view(np.uint64), most))

    run, fp, hot_run = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        run = np.concatenate([run, batch.column("run").to_numpy()])
        fp = np.concatenate([fp, batch.column("fp").to_numpy()])
        if hot_run is not None:
            n = int(np.searchsorted(run != hot_run, True))
            yield out(True, run[:n], fp[:n])
            run, fp, hot_run = run[n:], fp[n:], hot_run if n == len(run) else None
        if not len(run):
            continue
        cut = int(np.nonzero(run != run[-1])[0][-1]) + 1 if run[0] != run[-1] else 0  # the last run may go on
        if cut:
            yield from done(run[:cut], fp[:cut])
            run, fp = run[cut:], fp[cut:]
        if len(run) > longest:
            hot_run = run[0]
            yield out(True, run, fp)
            run, fp = run[:0], fp[:0]
    if len(run):
        yield from done(run, fp)


def _linked(rows: DataFrame, max_distance: int, longest: int) -> DataFrame:
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _links(batches, max_distance, longest)

    runs = rows.select("run", "fp").repartition("run").sortWithinPartitions("run")
    return runs.mapInArrow(links, "hot boolean, a long, b long")


def fingerprint_links(fps: DataFrame, max_distance: int = MAX_DISTANCE, block: int = BLOCK) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints of ``fps(fp long)`` within ``max_distance`` (0 to 3) bits."""
    if not 0 <= max_distance <= 3:
        raise ValueError("the keys guarantee distances up to 3")
    keys = fps.select("fp").distinct().mapInArrow(_key_rows, "run long, fp long")
    found = stage(_linked(keys, max_distance, block), "simhash-links")
    links, hot = found.where("not hot").select("a", "b"), found.where("hot").select(F.col("a").alias("run"), F.col("b").alias("fp"))
    if hot.isEmpty():
        return links
    # a long run in blocks: each entry meets its own block and every other one, a pair of blocks at a time
    blocks = hot.groupBy("run").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    pair = F.xxhash64("run", F.least("own", "other"), F.greatest("own", "other"))
    split = (
        hot.join(blocks, "run")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    )
    return links.union(_linked(split.select(pair.alias("run"), "fp"), max_distance, 1 << 62).select("a", "b"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: ``<id_col>, fingerprint, component_id, row_key, root``.

    ``root`` names the component; several components may have the same ``component_id`` (null, or an id that repeats).
    """
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("key")).alias("__row"),
        F.col(text_col).alias("__text"),
    )
    row_type = rows.schema["__row"].dataType.simpleString()

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _fingerprints(batches, shingle_words, SEED)

    marked = stage(rows.mapInArrow(prints, f"__row {row_type}, fp long").select("__row.*", "fp"), "simhash-marked")
    distinct = marked.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(fingerprint_links(distinct, max_distance, block))
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    named = join_hot(grouped.select("fp", "root"), least, "root").select("fp", "component_id", "root")
    return marked.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("key").alias("row_key"),
        "root",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the row of the smallest id of each group (one copy of it, if it repeats); all columns stay."""
    marked = near_duplicates(docs, id_col, text_col, **options).select(F.col(id_col).alias("id"), "root", "row_key")
    marked = stage(marked, "simhash-groups")
    # several rows of different texts may bear the smallest id: the one of the smallest key stays; null ids come last
    keeper = marked.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_key"))["row_key"].alias("keeper"))
    keys = marked.groupBy("root", F.col("row_key").alias("__key")).agg(F.count("*").alias("__n"))
    removed = (
        join_hot(keys, keeper, "root")
        .withColumn("__keep", (F.col("__key") == F.col("keeper")).cast("int"))
        .where("__keep < __n")
        .select("__key", "__keep")
    )
    return remove_rows(docs, stage(removed, "simhash-removed"), id_col, text_col)
