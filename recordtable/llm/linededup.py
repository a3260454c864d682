"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard verification, union-find.

A line's normal form is its text, trimmed of white space (``WHITE``, so a line end's ``\\r`` too) and lower-cased; blank lines
are left alone. Lines are alike if the Jaccard similarity of their sets of
``SHINGLE``-character shingles (a shorter line is one shingle) is at least
``threshold``; a class is a connected component, and of its lines in the whole
corpus only the first, by document id and line number, stays.

1. Tasks read Arrow batches of lines and compute ``BANDS * ROWS`` MinHash
   values per different line; each of the ``BANDS`` bands gives a key. At
   similarity 0.8 two lines share a key with probability 99.8 %
   (1 - (1 - 0.8^4)^12).
2. Rows of (key, line hash) are sorted by key; runs of several lines are kept
   and named by the hash of their members, so that lines which meet in many
   bands meet once. Their texts are fetched by a second read of the table,
   past a bounded bitmap, so texts of other lines are never shuffled.
3. The lines of a run meet in one task, which compares them exactly and returns
   the links of a spanning forest: a line already linked is not compared again,
   and never do all pairs leave the task. A run of more than ``BLOCK`` lines
   is cut into blocks, and each pair of blocks is a task's work of bounded size,
   so no link is lost.
4. Union-find over the links gives the classes.

Lines are 128-bit hashes of their normal forms in all shuffles.

Defined results: null text has no lines; a row that repeats (same id and text)
is one document; null ids come first; lines end at ``\\n``; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, row_key, stage, with_membership
from recordtable.llm.components import connected_components

SHINGLE = 7
THRESHOLD = 0.8
BANDS, ROWS = 12, 4
#: Lines of a key compared in one task's work; larger keys are cut into blocks of about this size.
BLOCK = 2048
#: Runs of more blocks than this are cut by their rarest shingles first: blocks alone would copy each line once per block.
WIDE = 8
#: White space that a line is trimmed of.
WHITE = " \t\r\x0b\x0c\x85\xa0\u2028\u2029\u3000"
#: Characters hashed at a time, so that the work stays in a core's cache.
CHUNK_CHARS = 1 << 16


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    x = (x ^ x >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return x ^ x >> np.uint32(16)


def _factors() -> np.ndarray:
    """Odd factors: each permutes the 32-bit hashes; the same in every task."""
    draw = np.random.default_rng(20240601).integers(0, 1 << 32, size=BANDS * ROWS, dtype=np.uint32)
    return draw | np.uint32(1)


def code_points(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all lines in a row, start of each line and the end) of a string array."""
    offsets = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    raw = np.frombuffer(lines.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    starts = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    points = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return points, starts[offsets - offsets[0]]


def _shingles(points: np.ndarray) -> np.ndarray:
    h = points[: len(points) - SHINGLE + 1] * np.uint32(0x01000193)
    for j in range(1, SHINGLE):
        h = (h ^ points[j : len(points) - SHINGLE + 1 + j]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    return _mixed(h)


def signatures(lines: pa.Array) -> np.ndarray:
    """(lines, BANDS * ROWS) MinHash values."""
    factor = _factors()
    out = np.empty((len(lines), BANDS * ROWS), dtype=np.uint32)
    if not len(lines):
        return out
    points, starts = code_points(lines)
    n = np.diff(starts)
    for i in np.nonzero(n < SHINGLE)[0]:
        whole = np.uint32(xxhash.xxh32_intdigest(points[starts[i] : starts[i + 1]].tobytes()))
        out[i] = whole * factor
    long = np.nonzero(n >= SHINGLE)[0]
    first = 0
    while first < len(long):
        last = int(np.searchsorted(starts[long + 1], starts[long[first]] + CHUNK_CHARS, side="right"))
        last = max(last, first + 1)
        some = long[first:last]
        begin, end = int(starts[some[0]]), int(starts[some[-1] + 1])
        h = _shingles(points[begin:end])
        # shingles that start in a line and end in it
        edge = np.zeros(end - begin + 1, dtype=np.int32)
        np.add.at(edge, starts[some] - begin, 1)
        np.add.at(edge, starts[some + 1] - begin - SHINGLE + 1, -1)
        h = h[np.cumsum(edge[:-1])[: len(h)] > 0]
        at = np.concatenate([[0], np.cumsum(n[some] - SHINGLE + 1)[:-1]])
        work, found = np.empty_like(h), np.empty((BANDS * ROWS, len(some)), dtype=np.uint32)
        for k in range(BANDS * ROWS):
            np.minimum.reduceat(np.multiply(h, factor[k], out=work), at, out=found[k])
        out[some] = found.T
        first = last
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(lines, BANDS) 64-bit keys."""
    part = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), part.shape[:2]).copy()
    for r in range(ROWS):
        h = (h ^ part[:, :, r]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without the line's text, with its keys; of lines that are equal within a batch one has them."""
    with np.errstate(over="ignore"):
        for b in batches:
            h = b.column("h").to_numpy()
            _, first = np.unique(h, return_index=True)
            first.sort()
            keys = band_keys(signatures(b.column("line").take(pa.array(first)).cast(pa.string())))
            has = np.zeros(len(h), dtype=np.int32)
            has[first] = BANDS
            offsets = pa.array(np.concatenate([[0], np.cumsum(has)]).astype(np.int32))
            columns = {c: b.column(c) for c in ("row", "no", "h", "g")}
            yield pa.record_batch(columns | {"keys": pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))})


def _mixed64(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Rows of one key that a task holds to name the run by its members; a longer run is named by its key.
NAMED_ROWS = 1 << 18


def _key_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (k, h) sorted by k: (run, h) of the keys with several different h."""

    def out(run: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch({"run": pa.array(run.view(np.int64)), "h": pa.array(h)})

    def done(k: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((h, k))
        k, h = k[order], h[order]
        first = np.ones(len(k), dtype=bool)
        first[1:] = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
        k, h = k[first], h[first]
        start = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0]
        size = np.diff(np.concatenate([start, [len(k)]]))
        name = _mixed64(np.add.reduceat(_mixed64(h.view(np.uint64)), start))
        several = np.repeat(size > 1, size)
        return out(np.repeat(name, size)[several], h[several])

    k, h, long = np.empty(0, np.int64), np.empty(0, np.int64), None
    with np.errstate(over="ignore"):
        for batch in batches:
            k = np.concatenate([k, batch.column("k").to_numpy()])
            h = np.concatenate([h, batch.column("h").to_numpy()])
            if long is not None:
                n = int(np.searchsorted(k != long, True))
                yield out(_mixed64(k[:n].view(np.uint64)), h[:n])
                long = long if n == len(k) else None
                k, h = k[n:], h[n:]
            if not len(k):
                continue
            cut = int(np.nonzero(k != k[-1])[0][-1]) + 1 if k[0] != k[-1] else 0
            if cut:
                yield done(k[:cut], h[:cut])
                k, h = k[cut:], h[cut:]
            if len(k) > NAMED_ROWS:
                long = k[0]
                yield out(_mixed64(k.view(np.uint64)), h)
                k, h = k[:0], h[:0]
        if len(k):
            yield done(k, h)


def shingle_set(line: str) -> set[str]:
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


#: Lines whose shingles are hashed together at most, and the bits of a shingle's hash beside the line's number.
CHUNK_LINES = 1 << 12
HASH_BITS = 52
#: Lines x different shingles up to which a run's intersections are counted at once.
DENSE_CELLS = 1 << 18


def _chunks(size: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``most`` entries and about ``CHUNK_CHARS`` in all (one entry may be longer)."""
    total, first = np.cumsum(size), 0
    while first < len(size):
        before = total[first] - size[first]
        last = int(np.searchsorted(total, before + CHUNK_CHARS, side="right"))
        last = min(max(last, first + 1), first + most)
        yield first, last
        first = last


def _hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of every shingle, number of its line) with repeats."""
    points, starts = code_points(lines)
    n = np.diff(starts)
    padded = np.concatenate([points, np.zeros(SHINGLE, np.uint32)]).astype(np.uint64)
    h = np.full(len(points) + 1, SHINGLE, dtype=np.uint64)
    for j in range(SHINGLE):  # windows at every place; those over a line's end are not taken
        h ^= padded[j : j + len(h)]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    count = np.maximum(n - SHINGLE + 1, 1)
    line = np.repeat(np.arange(len(n), dtype=np.uint64), count)
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    h = h[np.arange(len(line)) + np.repeat(starts[:-1] - first, count)]
    for i in np.nonzero(n < SHINGLE)[0]:  # a short line is one shingle of its own length
        h[first[i]] = xxhash.xxh3_64_intdigest(points[starts[i] : starts[i + 1]].tobytes(), int(n[i]))
    return _mixed64(h), line


def _distinct(key: np.ndarray) -> np.ndarray:
    key.sort()
    return key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key


def shingle_hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(different shingle hashes of all lines, in order; start of each line's and the end); at most ``CHUNK_LINES`` lines."""
    h, line = _hashes(lines)
    key = _distinct(line << np.uint64(HASH_BITS) | h >> np.uint64(64 - HASH_BITS))
    size = np.bincount((key >> np.uint64(HASH_BITS)).astype(np.int64), minlength=len(lines))
    return key & np.uint64((1 << HASH_BITS) - 1), np.concatenate([[0], np.cumsum(size)])


def pair_counts(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in both, shingles of one plus those of the other) of lines 0 and 1, 2 and 3, ...; one sort for all."""
    h, line = _hashes(lines)
    side = line & np.uint64(1)
    cut = np.uint64(64 - HASH_BITS + 1)
    key = _distinct(line >> np.uint64(1) << np.uint64(HASH_BITS) | h >> cut << np.uint64(1) | side)
    pair = (key >> np.uint64(HASH_BITS)).astype(np.int64)
    twice = key[1:] >> np.uint64(1) == key[:-1] >> np.uint64(1)
    pairs = len(lines) // 2
    return np.bincount(pair[1:][twice], minlength=pairs), np.bincount(pair, minlength=pairs)


def forest(flat: np.ndarray, start: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links (numbers of lines) of a spanning forest of the lines that are alike, from their sets of shingle hashes.

    Intersections of a line with all that are not yet in a tree are counted at once.
    """
    size = np.diff(start)
    numbers, flat = np.unique(flat, return_inverse=True)
    if len(size) * len(numbers) <= DENSE_CELLS:  # a small run: all intersections as one product
        cells = np.zeros((len(size), len(numbers)), dtype=np.float32)
        cells[np.repeat(np.arange(len(size)), size), flat] = 1
        both = cells @ cells.T
        alike = both >= threshold * (size[:, None] + size[None, :] - both)
        left, links = set(range(len(size))), []
        while left:
            todo = [left.pop()]
            while todo:
                x = todo.pop()
                new = left.intersection(np.nonzero(alike[x])[0].tolist())
                left -= new
                links += [(x, y) for y in new]
                todo += new
        return links
    flat, marked = flat.astype(np.int32), np.zeros(len(numbers), dtype=np.int32)
    left, links = np.arange(len(size)), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = left[(size[left] >= threshold * size[x]) & (size[x] >= threshold * size[left])]
            if not len(near):
                continue
            marked[flat[start[x] : start[x + 1]]] = 1
            both = np.empty(len(near), dtype=np.int64)
            for i, j in _chunks(size[near], len(near)):
                n = size[near[i:j]]
                at = np.concatenate([[0], np.cumsum(n)])
                places = np.arange(at[-1]) + np.repeat(start[near[i:j]] - at[:-1], n)
                both[i:j] = np.add.reduceat(marked[flat[places]], at[:-1])
            marked[flat[start[x] : start[x + 1]]] = 0
            alike = near[both >= threshold * (size[near] + size[x] - both)]
            links += [(x, int(y)) for y in alike]
            todo += alike.tolist()
            left = np.setdiff1d(left, alike, assume_unique=True)
    return links


def run_links(run: np.ndarray, lines: pa.Array, threshold: float) -> np.ndarray:
    """(links, 2) numbers of lines: a spanning forest of the alike lines of every run (equal neighbours in ``run``)."""
    out = [np.empty((0, 2), dtype=np.int64)]
    start = np.nonzero(np.concatenate([[True], run[1:] != run[:-1]]))[0]
    size = np.diff(np.concatenate([start, [len(run)]]))
    twos, more = start[size == 2], np.nonzero(size > 2)[0]
    chars = pc.binary_length(lines).to_numpy()
    for i, j in _chunks(chars[twos] + chars[twos + 1], CHUNK_LINES // 2):  # pairs, many at once
        some = twos[i:j]
        both, n = pair_counts(lines.take(pa.array(np.stack([some, some + 1], axis=1).ravel())))
        alike = some[both >= threshold * (n - both)]
        out.append(np.stack([alike, alike + 1], axis=1))
    for r in more:
        parts, at = [], [0]
        for i, j in _chunks(chars[start[r] : start[r] + size[r]], CHUNK_LINES):
            flat, own = shingle_hashes(lines.slice(start[r] + i, j - i))
            parts.append(flat)
            at += (own[1:] + at[-1]).tolist()
        links = forest(np.concatenate(parts), np.array(at), threshold)
        out.append(np.array(links, dtype=np.int64).reshape(-1, 2) + start[r])
    return np.concatenate(out)


_NODE = "struct<h:bigint,g:bigint>"
_LINKS = f"hot boolean, run bigint, a {_NODE}, b {_NODE}, line string"


def _link_runs(batches: Iterator[pa.RecordBatch], threshold: float, longest: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by ``run``: links (hot false); runs over ``longest`` come out as they are (hot true: run, a, line).

    Holds one Arrow batch and one run of at most ``longest`` lines.
    """

    def node(t: pa.Table) -> pa.Array:
        h, g = (t.column(c).combine_chunks() for c in ("h", "g"))
        return pa.StructArray.from_arrays([h, g], ["h", "g"])

    def out(hot: bool, a: pa.Table, b: pa.Table) -> pa.RecordBatch:
        line = a.column("line").combine_chunks() if hot else pa.nulls(len(a), pa.string())
        columns = {"hot": pa.array(np.full(len(a), hot)), "run": a.column("run").combine_chunks(), "a": node(a), "b": node(b)}
        return pa.record_batch(columns | {"line": line})

    def done(t: pa.Table) -> Iterator[pa.RecordBatch]:
        run = t.column("run").to_numpy()
        _, number, size = np.unique(run, return_inverse=True, return_counts=True)
        long = size[number] > longest
        if long.any():
            some = t.take(pa.array(np.nonzero(long)[0]))
            yield out(True, some, some)
            t = t.take(pa.array(np.nonzero(~long)[0]))
            run = t.column("run").to_numpy()
        if len(t):
            with np.errstate(over="ignore"):
                links = run_links(run, t.column("line").combine_chunks(), threshold)
            if len(links):
                yield out(False, t.take(pa.array(links[:, 0])), t.take(pa.array(links[:, 1])))

    held: pa.Table | None = None
    hot_run = None
    for batch in batches:
        t = pa.table([batch.column("run"), batch.column("h"), batch.column("g"), batch.column("line").cast(pa.string())], ["run", "h", "g", "line"])
        t = pa.concat_tables([held, t]).combine_chunks() if held is not None else t
        run = t.column("run").to_numpy()
        if hot_run is not None and len(t):
            n = int(np.searchsorted(run != hot_run, True))
            some = t.slice(0, n)
            yield out(True, some, some)
            hot_run = hot_run if n == len(t) else None
            t, run = t.slice(n), run[n:]
        held = None
        if not len(t):
            continue
        cut = int(np.nonzero(run != run[-1])[0][-1]) + 1 if run[0] != run[-1] else 0  # the last run may go on
        if cut:
            yield from done(t.slice(0, cut).combine_chunks())
        held = t.slice(cut)
        if len(held) > longest:
            hot_run = run[-1]
            yield out(True, held, held)
            held = None
    if held is not None and len(held):
        yield from done(held.combine_chunks())


def _linked(rows: DataFrame, threshold: float, longest: int) -> DataFrame:
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _link_runs(batches, threshold, longest)

    runs = rows.select("run", "h", "g", "line").repartition("run").sortWithinPartitions("run")
    return runs.mapInArrow(links, _LINKS)


def _line_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per line and different shingle: its hash, and how many the line has."""
    with np.errstate(over="ignore"):
        for b in batches:
            line = b.column("line").cast(pa.string())
            for i, j in _chunks(pc.binary_length(line).to_numpy(), CHUNK_LINES):
                flat, start = shingle_hashes(line.slice(i, j - i))
                size = np.diff(start)
                row = pa.array(np.repeat(np.arange(i, j), size))
                columns = {c: b.column(c).take(row) for c in ("run", "h", "g")}
                yield pa.record_batch(columns | {"size": pa.array(np.repeat(size, size)), "s": pa.array(flat.astype(np.int64))})


def prefix_runs(hot: DataFrame, threshold: float) -> DataFrame:
    """``hot(run, h, g, line)`` as smaller runs: lines of a run that share one of the rarest shingles of each.

    Two sets of similarity t share t of the larger one's shingles at least, so
    in an order common to both they share one of the first ``size - ceil(t * size) + 1`` of each.
    The order is by how many lines of the run have a shingle, the rarest first.
    """
    shingles = hot.select("run", "h", "g", "line").mapInArrow(_line_shingles, "run long, h long, g long, size long, s long")
    shingles = stage(shingles.withColumn("t", F.xxhash64("run", "s")), "line-shingles")
    counted = join_hot(shingles, shingles.groupBy("t").agg(F.count("*").alias("n")), "t")
    first = F.row_number().over(Window.partitionBy("run", "h", "g").orderBy("n", "s", "t"))  # a line's shingles
    prefix = F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1
    meet = counted.withColumn("__first", first).where((F.col("__first") <= prefix) & (F.col("n") > 1)).select("run", "h", "g", "t")
    return hot.join(meet, ["run", "h", "g"]).select(F.col("t").alias("run"), "h", "g", "line")


def line_links(rows: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, wide: int = WIDE) -> DataFrame:
    """Links ``a, b`` that connect all alike lines of each run of ``rows(run, h, g, line)``."""
    found = stage(_linked(rows, threshold, block), "line-links")
    links, hot = found.where("not hot").select("a", "b"), found.where("hot").select("run", "a.h", "a.g", "line")
    if hot.isEmpty():
        return links
    blocks = hot.groupBy("run").agg(F.ceil(F.count("*") / block).alias("blocks"))
    sized = stage(hot.join(blocks, "run"), "line-hot")
    few, many = sized.where(F.col("blocks") <= wide), sized.where(F.col("blocks") > wide)
    links = links.union(_block_links(few, threshold))
    if many.isEmpty():
        return links
    found = stage(_linked(prefix_runs(many, threshold), threshold, block), "line-prefix-links")
    links, hot = links.union(found.where("not hot").select("a", "b")), found.where("hot").select("run", "a.h", "a.g", "line")
    if hot.isEmpty():
        return links
    blocks = hot.groupBy("run").agg(F.ceil(F.count("*") / block).alias("blocks"))
    return links.union(_block_links(hot.join(blocks, "run"), threshold))


def _block_links(hot: DataFrame, threshold: float) -> DataFrame:
    """Links of runs of ``hot(run, h, g, line, blocks)``, a pair of blocks at a time."""
    split = hot.withColumn("own", F.pmod(F.xxhash64("h", "g"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    pair = F.xxhash64("run", F.least("own", "other"), F.greatest("own", "other")).alias("run")
    return _linked(split.select(pair, "h", "g", "line"), threshold, 1 << 62).select("a", "b")


def _trimmed(line: str) -> Column:
    """The line without white space at its ends; the general trim is for lines that end in more than spaces."""
    c = F.trim(line)
    odd = reduce(lambda a, b: a | b, [edge(c, F.lit(x)) for x in WHITE[1:] for edge in (F.startswith, F.endswith)])
    return F.when(odd, F.trim(line, F.lit(WHITE))).otherwise(c)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, key, no, line, h`` of every line that is not blank; ``h`` is the first of its two hashes."""
    each = docs.select(
        F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("key"), F.split(F.lower(text_col), "\n").alias("lines")
    )
    each = each.select("id", "key", F.posexplode("lines").alias("no", "raw")).withColumn("line", _trimmed("raw")).where("line <> ''")
    return each.select("id", "key", "no", "line", F.xxhash64("line").alias("h"))


def _second_hash() -> Column:
    return F.xxhash64(F.lit(1), "line").alias("g")


def keyed_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row (id, key), no, h, g, keys`` of every line that is not blank, written once; repeats of a line may lack keys."""
    lines = _lines(docs, id_col, text_col).select(F.struct("id", "key").alias("row"), "no", "h", _second_hash(), "line")
    kind = lines.schema["row"].dataType.simpleString()
    return stage(lines.mapInArrow(_keys, f"row {kind}, no int, h long, g long, keys array<bigint>"), "line-keys")


def line_classes(
    docs: DataFrame, keyed: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``node, root`` of the different lines that are alike to another one (``struct<h, g>``, 128-bit line hashes)."""
    lines = _lines(docs, id_col, text_col)
    rows = keyed.select("h", F.explode("keys").alias("k"))
    found = rows.repartition("k").sortWithinPartitions("k").mapInArrow(_key_runs, "run long, h long")
    found = stage(found.distinct(), "line-runs")

    wanted = found.select("h").distinct()
    texts = with_membership(lines.select("h", "line"), F.col("h"), wanted, "h", "maybe").where("maybe")
    # lines of equal 64-bit hashes are told apart by their second hash
    texts = texts.select("h", _second_hash(), "line").groupBy("h", "g").agg(F.min("line").alias("line"))
    links = line_links(found.join(texts, "h"), threshold)
    return connected_components(links.distinct())


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per line that is not blank: ``<id_col>, row_key, line_no, keep_id, keep_line, kept``.

    ``keep_id, keep_line``: the line that stays of the class (from 0, by document).
    """
    keyed = keyed_lines(docs, id_col, text_col)
    classes = line_classes(docs, keyed, id_col, text_col, threshold)
    classes = stage(classes.select("node.h", "node.g", "root"), "line-classes")
    lines = keyed.select("row.id", "row.key", "no", "h", "g")
    # only lines that may have a class are shuffled to meet it
    maybe = with_membership(lines, F.col("h"), classes, "h", "maybe")
    alone = maybe.where("not maybe").drop("maybe").withColumn("root", F.struct("h", "g"))
    named = maybe.where("maybe").drop("maybe").join(classes, ["h", "g"], "left").withColumn("root", F.coalesce("root", F.struct("h", "g")))
    lines = stage(alone.unionByName(named.select(alone.columns)).drop("h", "g"), "lines")

    place = F.struct("id", "no", "key")
    # a line that is the only one of its class need not meet any other
    shared = lines.groupBy("root.h", "root.g").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(shared.select(F.xxhash64(F.struct("h", "g")).alias("r")), "line-shared")
    maybe = with_membership(lines, F.xxhash64("root"), shared, "r", "maybe")
    first = maybe.where("maybe").groupBy("root").agg(F.min(place).alias("first"))
    several = join_hot(maybe.where("maybe").drop("maybe"), first, "root")
    single = maybe.where("not maybe").drop("maybe").withColumn("first", place)
    return single.unionByName(several.select(single.columns)).select(
        F.col("id").alias(id_col),
        F.col("key").alias("row_key"),
        F.col("no").alias("line_no"),
        F.col("first.id").alias("keep_id"),
        F.col("first.no").alias("keep_line"),
        place.eqNullSafe(F.col("first")).alias("kept"),
    )


def without_lines(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the lines that do not stay taken out of the text; all rows and columns stay."""
    gone = decided.where("not kept").groupBy(F.col("row_key").alias("__row")).agg(F.collect_set("line_no").alias("__gone"))
    kept: Column = F.filter(F.split(text_col, "\n"), lambda x, i: ~F.array_contains("__gone", i))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    keyed = docs.withColumn("__row", row_key(docs, id_col, text_col))
    return keyed.join(gone, "__row", "left").withColumn(text_col, text).select(*docs.columns)
