"""Merkle manifest of a dataset: a leaf per row, a subtree per group, a root over the groups' subroots.

A leaf is the SHA-256 of a row's columns; the leaves of a group ascend by id;
every ``arity`` consecutive nodes (fewer at the end, even one) become the
SHA-256 of their concatenated hex digests until one is left, the group's
subroot. Subroots in the order of their groups (null first, then bytewise)
become the root in the same way. Every row gets its proof, the siblings on its
path, and the root that its presented content folds to along that proof.

Bitmap-rank indexing. A group's ids are a bitmap of 64-bit words of which only
those in use are kept; tasks' partial words are merged by ``bit_or``. A
popcount directory sums words to containers of 2**22 ids, those to supers of
2**42 and those to the group, and gives each word the number of leaves before
it. A leaf's place in its group is that number plus the popcount of the lower
bits of its word: one equi-join of leaves with words, no sort of the leaves.
Every window of the directory runs over at most 2**20 rows (2**22 for the supers
of a group), whatever the data.

Keyed slot arrays. The leaves of ``SLOTS`` consecutive places are one row, an
array by slot, which is reduced by all its levels in one step; what remains is
placed among the next arrays in the same way, so 10**11 leaves take four
rounds. Proofs come down by the same keys, and a leaf's proof is put together
only where its result is written.

Texts are read once, in the JVM. A group of any size is spread by its words and
arrays. Nothing that grows with the data is broadcast or collected: the driver
learns the largest group's size and the number of groups.

Defined results: null columns are ``-`` in the leaf; a null group is a group
of its own, the first; rows with a null id come first in their group; rows of equal id are in order of
their leaves (equal rows are interchangeable), ranked by a range sort of such
rows alone; a lone leaf is its subroot and a lone subroot the root, with an
empty proof; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, stage
from recordtable.llm.places import places

#: Slots of an array at most; the largest power of the arity in it is used.
SLOTS = 1024
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
EMPTY = b""


def leaf_digest(columns: list[Column]) -> Column:
    """Binary SHA-256 of the columns: each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node(run: list[str]) -> str:
    """Digest of a run of nodes given as hex text."""
    return hashlib.sha256("".join(run).encode()).hexdigest()


def height(leaves: int, arity: int) -> int:
    """Levels from so many leaves to one node."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // arity), levels + 1
    return levels


def levels(slots: list[str], count: int, arity: int) -> list[list[str]]:
    """The nodes of an array level by level, from its slots to the node that stands for it."""
    out = [slots]
    for _ in range(count):
        below = out[-1]
        out.append([node(below[i : i + arity]) for i in range(0, len(below), arity)])
    return out


def siblings(tree: list[list[str]], slot: int, arity: int) -> list[str]:
    out: list[str] = []
    for below in tree[:-1]:
        first = slot - slot % arity
        out += below[first:slot] + below[slot + 1 : first + arity]
        slot //= arity
    return out


def fold(leaf: str, place: int, count: int, proof: Iterator[str], arity: int) -> str:
    """The node that a leaf at ``place`` of ``count`` gives with the siblings that ``proof`` yields."""
    while count > 1:
        own = place % arity
        others = min(arity, count - (place - own)) - 1
        run = [next(proof) for _ in range(others)]
        leaf = node([*run[:own], leaf, *run[own:]])
        place, count = place // arity, -(-count // arity)
    return leaf


def _arrays(items: DataFrame, size: int, payload: list[str]) -> DataFrame:
    """``g, n, chunk, slots``: items ``g, n, place, digest`` of ``size`` consecutive places in one row."""
    slot = (F.col("place") % size).cast("int").alias("slot")
    keyed = items.withColumn("chunk", F.expr(f"place div {size}"))
    rows = F.array_sort(F.collect_list(F.struct(slot, "digest", *payload)))
    return keyed.groupBy("g", "n", "chunk").agg(rows.alias("slots"))


def _struct_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.StructArray]:
    """(offsets, values) of an array column."""
    column = batch.column(name)
    return column.offsets.to_numpy(), column.values


def _hexes(values: pa.Array) -> list[str | None]:
    return [None if v is None else v.hex() for v in values.to_pylist()]


def _reduce(batches: Iterator[pa.RecordBatch], arity: int, size: int) -> Iterator[pa.RecordBatch]:
    """Node of each array, with its place and the number of such nodes in the group."""
    span = height(size, arity)
    for b in batches:
        offsets, values = _struct_column(b, "slots")
        digests = _hexes(values.field("digest"))
        counts = b.column("n").to_pylist()
        top = [
            levels(digests[offsets[i] : offsets[i + 1]], min(span, height(n, arity)), arity)[-1][0] for i, n in enumerate(counts)
        ]
        yield pa.record_batch(
            {
                "g": b.column("g"),
                "n": pa.array([-(-n // size) for n in counts], pa.int64()),
                "place": b.column("chunk"),
                "digest": pa.array([bytes.fromhex(t) for t in top], pa.binary()),
            }
        )


def _down(batches: Iterator[pa.RecordBatch], arity: int, size: int) -> Iterator[pa.RecordBatch]:
    """Proof of each slot: its siblings in the array, then the array's own proof."""
    span = height(size, arity)
    for b in batches:
        offsets, values = _struct_column(b, "slots")
        digests = _hexes(values.field("digest"))
        chunks, counts, above = (b.column(c).to_pylist() for c in ("chunk", "n", "proof"))
        rows, place, proof = [], [], []
        for i, n in enumerate(counts):
            tree = levels(digests[offsets[i] : offsets[i + 1]], min(span, height(n, arity)), arity)
            for slot in range(len(tree[0])):
                rows.append(i)
                place.append(chunks[i] * size + slot)
                proof.append(bytes.fromhex("".join(siblings(tree, slot, arity))) + above[i])
        at = pa.array(rows, pa.int64())
        yield pa.record_batch(
            {"g": b.column("g").take(at), "place": pa.array(place, pa.int64()), "proof": pa.array(proof, pa.binary())}
        )


def _judge(batches: Iterator[pa.RecordBatch], arity: int, size: int, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of the leaves' arrays: leaf, roots, proof and the root that the presented leaf folds to."""
    span = height(size, arity)
    for b in batches:
        offsets, values = _struct_column(b, "slots")
        digests, presented = _hexes(values.field("digest")), _hexes(values.field("presented"))
        names = ("chunk", "n", "proof", "root", "g_place", "groups")
        chunks, counts, above, root, g_place, groups = (b.column(c).to_pylist() for c in names)
        at: list[int] = []
        place, proofs, folded = [], [], []
        for i, n in enumerate(counts):
            first = int(offsets[i])
            tree = levels(digests[first : offsets[i + 1]], min(span, height(n, arity)), arity)
            upper = [above[i][k : k + 32].hex() for k in range(0, len(above[i]), 32)]
            for slot in range(len(tree[0])):
                own = chunks[i] * size + slot
                proof = siblings(tree, slot, arity) + upper
                rest = iter(proof)
                subroot = fold(presented[first + slot] or tree[0][slot], own, n, rest, arity)
                folded.append(bytes.fromhex(fold(subroot, g_place[i], groups[i], rest, arity)))
                proofs.append(bytes.fromhex("".join(proof)))
                place.append(own)
                at.append(i)
        row = pa.array(at, pa.int64())
        yield pa.record_batch(
            {
                "__id": values.field("__id").slice(int(offsets[0]), len(at)).cast(id_type),
                "leaf": values.field("digest").slice(int(offsets[0]), len(at)),
                "subroot": b.column("subroot").take(row),
                "root": b.column("root").take(row),
                "proof": pa.array(proofs, pa.binary()),
                "folded_root": pa.array(folded, pa.binary()),
                "verified": pa.array([f == root[i] for f, i in zip(folded, at, strict=True)], pa.bool_()),
                "place": pa.array(place, pa.int64()),
            }
        )


def _array_tables(items: DataFrame, largest: int, size: int, arity: int, payload: list[str]) -> tuple[list[DataFrame], DataFrame]:
    """(arrays of each round, one item per group) for items ``g, n, place, digest`` of at most ``largest`` per group."""
    tables = []
    while True:
        tables.append(stage(_arrays(items, size, payload), "manifest-arrays"))
        items = tables[-1].select("g", "n", "chunk", "slots").mapInArrow(
            lambda batches: _reduce(batches, arity, size), "g string, n long, place long, digest binary"
        )
        largest, payload = -(-largest // size), []
        if largest <= 1:
            return tables, items


def _with_proofs(tables: list[DataFrame], tops: DataFrame, size: int, arity: int) -> DataFrame:
    """The lowest arrays with ``proof`` and the other columns of ``tops(g, proof, ...)``."""
    carried = [c for c in tops.columns if c not in ("g", "proof")]
    above = tops.withColumn("chunk", F.lit(0).cast("long"))
    for table in reversed(tables[1:]):
        joined = table.join(above.select("g", "chunk", "proof"), ["g", "chunk"])
        above = joined.select("g", "n", "chunk", "slots", "proof").mapInArrow(
            lambda batches: _down(batches, arity, size), "g string, place long, proof binary"
        )
        above = above.withColumnRenamed("place", "chunk")
    out = tables[0].join(above.select("g", "chunk", "proof"), ["g", "chunk"])
    return out.join(tops.select("g", *carried), "g") if carried else out


def leaf_places(leaves: DataFrame) -> DataFrame:
    """``leaves(g, some, id, digest, ...)`` with ``place`` in the group and its number of leaves ``n``.

    ``some``: false for a null id, whose ``id`` is 0.
    """
    word, bit = F.shiftright("id", 6).alias("word"), F.expr("shiftleft(1L, cast(id & 63 as int))")
    words = leaves.groupBy("g", "some", word).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("rows"))
    words = stage(words, "manifest-words")

    total = F.sum("rows").alias("rows")
    containers = words.groupBy("g", "some", F.shiftright("word", 16).alias("c")).agg(total)
    containers = stage(containers, "manifest-containers")
    supers = containers.groupBy("g", "some", F.shiftright("c", 20).alias("s")).agg(total)

    def before(*same: str, by: list[str]) -> Column:
        window = Window.partitionBy(*same).orderBy(*by)
        return F.coalesce(F.sum("rows").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    supers = supers.withColumn("s_before", before("g", by=["some", "s"])).withColumn("n", F.sum("rows").over(Window.partitionBy("g")))
    c_before = before("g", "some", "s", by=["c"])
    containers = containers.withColumn("s", F.shiftright("c", 20)).withColumn("c_before", c_before)
    containers = containers.join(supers.drop("rows"), ["g", "some", "s"])
    containers = containers.select("g", "some", "c", "n", (F.col("s_before") + F.col("c_before")).alias("c_before"))
    directory = words.withColumn("c", F.shiftright("word", 16)).withColumn("w_before", before("g", "some", "c", by=["word"]))
    directory = directory.join(containers, ["g", "some", "c"])
    offset = (F.col("c_before") + F.col("w_before")).alias("offset")
    directory = stage(directory.select("g", "some", "word", "bits", "rows", "n", offset), "manifest-directory")

    keyed = leaves.withColumn("word", F.shiftright("id", 6))
    lower = F.expr("bits & ~shiftleft(-1L, cast(id & 63 as int))")
    single = F.col("rows") == F.bit_count("bits")
    found = keyed.join(directory.where(single), ["g", "some", "word"])
    out = found.withColumn("place", F.col("offset") + F.bit_count(lower)).select(*leaves.columns, "n", "place")
    if directory.where(~single).isEmpty():
        return out

    # words in which some id has several rows: the word's counts take the place of its bits
    rows = keyed.join(directory.where(~single).select("g", "some", "word", "n", "offset"), ["g", "some", "word"])
    rows = stage(rows, "manifest-repeated")
    copies = rows.groupBy("g", "some", "word", "id").agg(F.count("*").alias("copies"))
    same = Window.partitionBy("g", "some", "word").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.withColumn("below", F.coalesce(F.sum("copies").over(same), F.lit(0))).drop("word")  # 64 ids at most
    by = ["g", "some", "id"]
    ranked = places(rows, [*by, "digest"], "__at")
    first = ranked.groupBy(*by).agg(F.min("__at").alias("__first"))
    copies = copies.join(first, by).withColumn("__k", F.struct(*by))
    ranked = ranked.withColumn("__k", F.struct(*by)).drop(*by)
    ranked = join_hot(ranked, copies, "__k").drop("__k")
    place = F.col("offset") + F.col("below") + F.col("__at") - F.col("__first")
    return out.unionByName(ranked.withColumn("place", place).select(*leaves.columns, "n", "place"))


def manifest(
    docs: DataFrame,
    presented: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    group_col: str = "lang",
    columns: tuple[str, ...] = COLUMNS,
    arity: int = 2,
) -> DataFrame:
    """One row per input row: ``<id_col>, leaf, subroot, root, proof, folded_root, verified, place``; digests are binary.

    ``id_col`` holds whole numbers. ``proof``: the siblings' digests one after the other, from the leaf's run up.
    ``presented``: content of columns to check in place of the row's own (none: the row itself).
    """
    if arity < 2:
        raise ValueError("arity must be at least 2")
    size = arity ** max(1, int(math.log(SLOTS, arity) + 1e-9))
    own = leaf_digest([F.col(c) for c in columns])
    shown = leaf_digest([(presented or {}).get(c, F.col(c)) for c in columns])
    touched = [c for c in columns if c in (presented or {})]
    differs = F.lit(False)
    for c in touched:
        differs = differs | ~presented[c].eqNullSafe(F.col(c))
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = docs.select(
        group.alias("g"),
        F.col(id_col).isNotNull().alias("some"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"),
        own.alias("digest"),
        F.when(differs, shown).alias("presented"),
    )
    leaves = stage(leaves, "manifest-leaves")

    items = leaf_places(leaves).withColumn("__id", F.when(F.col("some"), F.col("id"))).drop("some", "id")
    sizes = leaves.groupBy("g").agg(F.count("*").alias("n")).agg(F.max("n").alias("largest"), F.count("*").alias("groups")).first()
    largest, groups = sizes["largest"] or 0, sizes["groups"]
    tables, subroots = _array_tables(items, largest, size, arity, ["presented", "__id"])
    subroots = stage(subroots.select("g", "digest"), "manifest-subroots")

    # the tree over the groups: one group whose items are the subroots
    ordered = places(subroots, ["g"], "place").withColumnRenamed("g", "name")
    uppers = ordered.withColumn("g", F.lit("")).withColumn("n", F.lit(groups).cast("long"))
    top_tables, root = _array_tables(uppers, groups, size, arity, ["name"])
    root = root.select("g", F.col("digest").alias("root"), F.lit(EMPTY).alias("proof"))
    upper = _with_proofs([t.select("g", "n", "chunk", "slots") for t in top_tables], root, size, arity)
    upper = upper.select("g", "n", "chunk", "slots", "proof").mapInArrow(
        lambda batches: _down(batches, arity, size), "g string, place long, proof binary"
    )
    tops = uppers.join(upper.select("place", "proof"), "place").join(root.select("g", "root"), "g")
    tops = tops.select(
        F.col("name").alias("g"),
        "proof",
        F.col("digest").alias("subroot"),
        "root",
        F.col("place").alias("g_place"),
        F.col("n").alias("groups"),
    )
    tops = stage(tops, "manifest-tops")

    whole = _with_proofs(tables, tops, size, arity)
    fields = "leaf binary, subroot binary, root binary, proof binary, folded_root binary, verified boolean, place long"
    names = ["g", "n", "chunk", "slots", "proof", "subroot", "root", "g_place", "groups"]
    judged = whole.select(*names).mapInArrow(lambda batches: _judge(batches, arity, size, pa.int64()), f"__id long, {fields}")
    return judged.withColumn("__id", F.col("__id").cast(docs.schema[id_col].dataType)).withColumnRenamed("__id", id_col)
