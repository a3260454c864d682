"""Prefix trie of conversations by van Emde Boas recursion: every distinct run of first turns is a node.

The sequences, at most ``2**k`` turns deep, are cut at half depth. The cut
prefixes are named: equal ones get one name, the smallest sequence id that has
them. That leaves the upper trie and, below each name, a lower forest, all of
half the height; they are cut in turn, and all blocks of one height are worked on in
one round. A round needs no turn but only the hashes of whole halves of its
blocks, which are put together from quarters beforehand (bottom up, in
pairs), so round by round the rows halve and the whole naming moves about four rows
per turn, whatever the depth. A prefix of depth d is named in the round of
d's lowest set bit, from the name of the block's root and the hash of the half.

Totals are grafted upward in the opposite order: two blocks, of the
same height, one below the other, become one when each cut node's lower
forest is summed and added to the nodes on its path in the upper block.

A node is (smallest member, depth). Sequences are never collected: a turn is
one row of numbers throughout, so a conversation of any length is spread over tasks,
and a prefix that any share of the conversations begin with is one partial aggregate
and a join that AQE can split. Members that end at one node are joined to text
in runs of 2**12 ids in parallel, and the runs are streamed through its SHA-256, which
has no parallel form; memory is bounded there too. Hashes are 128 bits wide and taken of
SHA-256 digests. The driver learns the greatest depth.

Defined results: turns are in order of ``turn`` (null first), equal ones in that of
their digest of role and text, so repeated rows are repeated turns; null role
or text is empty; rows without a conversation id are left out; no rows give
no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, stage
from recordtable.llm.places import places

#: Ids of a run that are joined to text in one task: those that agree but for so many low bits.
RUN_BITS = 12
NOTHING = hashlib.sha256(b"").hexdigest()


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and U+0009 to U+000D."""
    return F.size(F.array_remove(F.split(text, "[\\x20\\x09-\\x0D]+"), "")).cast("long")


def turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``seq, depth, h1, h2, words``: every turn with its place in its conversation, from 1, and the hashes of its content."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("seq"), F.col(turn_col).alias("turn"), digest.alias("digest"), word_count(text).alias("words")
    )
    placed = places(rows, ["seq", "turn", "digest"], "at")
    first = placed.groupBy("seq").agg(F.min("at").alias("first"))
    numbered = join_hot(placed, first, "seq")
    return numbered.select(
        "seq",
        (F.col("at") - F.col("first") + 1).alias("depth"),
        F.xxhash64("digest", F.lit(1)).alias("h1"),
        F.xxhash64("digest", F.lit(2)).alias("h2"),
        "words",
    )


def _blocks(steps: DataFrame, rounds: int) -> list[DataFrame]:
    """``seq, b, h1, h2, words`` for whole blocks of 1, 2, 4, ... turns, ``words`` being those of the last turn."""
    out = [steps.select("seq", (F.col("depth") - 1).alias("b"), "h1", "h2", "words")]
    odd = F.expr("b & 1 = 1")
    for t in range(rounds):
        halves = [F.max(F.when(side, F.col(h))).alias(f"{n}{h}") for n, side in (("l", ~odd), ("r", odd)) for h in ("h1", "h2")]
        pair = out[-1].groupBy("seq", F.shiftright("b", 1).alias("b")).agg(
            *halves, F.max(F.when(odd, F.col("words"))).alias("words"), F.count("*").alias("n")
        )
        parts = ("lh1", "lh2", "rh1", "rh2")
        hashes = [F.xxhash64(*parts, F.lit(i)).alias(f"h{i}") for i in (1, 2)]
        out.append(stage(pair.where("n = 2").select("seq", "b", *hashes, "words"), f"trie-blocks-{t + 1}"))
    return out


def _name(blocks: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(``seq, depth, name`` of every prefix, ``name, depth, n_convs, words`` of every node)."""
    names: DataFrame | None = None
    nodes: DataFrame | None = None
    for t in range(len(blocks) - 1, -1, -1):
        # the upper halves of all blocks of 2**(t + 1) turns; ``a``: depth of the block's root
        cut = blocks[t].where("b & 1 = 0").withColumn("a", F.expr(f"b * {1 << t}L")).drop("b")
        if names is None:
            cut = cut.withColumn("up", F.lit(0).cast("long"))
        else:
            root = names.select("seq", F.col("depth").alias("a"), F.col("name").alias("up"))
            cut = cut.join(root, ["seq", "a"], "left").withColumn("up", F.coalesce("up", F.lit(0).cast("long")))
        key = F.struct("a", "up", "h1", "h2").alias("key")
        cut = stage(cut.select("seq", key, "words"), f"trie-cuts-{t}")
        named = cut.groupBy("key").agg(F.min("seq").alias("name"), F.count("*").alias("n_convs"), F.max("words").alias("words"))
        depth = F.expr(f"key.a + {1 << t}L").alias("depth")
        named = stage(named, f"trie-named-{t}")
        new = stage(join_hot(cut.drop("words"), named.select("key", "name"), "key").select("seq", depth, "name"), f"trie-names-{t}")
        more = named.select("name", depth, "n_convs", "words")
        names = new if names is None else names.unionByName(new)
        nodes = more if nodes is None else nodes.unionByName(more)
    return names, nodes


def _graft(nodes: DataFrame, names: DataFrame, rounds: int) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved`` summed over their subtrees."""
    kept = ["parent", "n_convs", "n_children"]
    for t in range(rounds):
        # ``m``: depths at which an upper block of 2**t levels ends and its lower forest begins
        tops = nodes.where(F.expr(f"(depth - 1) % {2 << t} = {1 << t}"))
        forest = tops.groupBy(F.col("parent").alias("seq"), (F.col("depth") - 1).alias("m")).agg(
            F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
        )
        forest = forest.withColumn("block", F.expr(f"(m - 1) div {1 << t}")).drop("m")
        path = names.withColumn("block", F.expr(f"(depth - 1) div {1 << t}")).where("block & 1 = 0")
        grafts = path.join(forest, ["seq", "block"]).select("name", "depth", "n_leaves", "saved")
        both = nodes.unionByName(grafts, allowMissingColumns=True).groupBy("name", "depth")
        summed = [F.max(c).alias(c) for c in kept] + [F.sum(c).alias(c) for c in ("n_leaves", "saved")]
        nodes = stage(both.agg(*summed), f"trie-totals-{t}")
    return nodes


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the comma-joined runs of each node; rows come by node and run."""
    at, state = None, hashlib.sha256()
    out: list[tuple[int, int, str]] = []
    for b in batches:
        for name, depth, ids in zip(*(b.column(c).to_pylist() for c in ("name", "depth", "ids")), strict=True):
            if at == (name, depth):
                state.update(b"," + ids.encode())
                continue
            if at is not None:
                out.append((*at, state.hexdigest()))
            at, state = (name, depth), hashlib.sha256(ids.encode())
        yield _batch(out)
        out = []
    if at is not None:
        yield _batch([(*at, state.hexdigest())])


def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    names, depths, digests = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.record_batch(
        {"name": pa.array(names, pa.int64()), "depth": pa.array(depths, pa.int64()), "ends_sha256": pa.array(digests, pa.string())}
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """``name, depth, ends_sha256`` of ``ends(name, depth, seq)``: ids in numeric order, joined by commas."""
    run = F.shiftright("seq", RUN_BITS).alias("run")
    ids = F.array_join(F.array_sort(F.collect_list("seq")).cast("array<string>"), ",")
    runs = ends.groupBy("name", "depth", run).agg(ids.alias("ids"))
    dealt = runs.repartition("name", "depth").sortWithinPartitions("name", "depth", "run")
    return dealt.select("name", "depth", "ids").mapInArrow(_digests, "name long, depth long, ends_sha256 string")


def prefix_trie(steps: DataFrame, sequences: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``steps(seq, depth, h1, h2, words)``: depths of a sequence count from 1
    without gaps; ``sequences(seq)`` lists all ids once, those without steps too.
    """
    deepest = steps.agg(F.max("depth")).first()[0] or 0
    rounds = max(0, deepest - 1).bit_length()
    names, nodes = _name(_blocks(steps, rounds))

    above = names.select(F.col("seq").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    nodes = stage(nodes.join(above, ["name", "depth"], "left"), "trie-nodes")
    children = nodes.where("depth > 1").groupBy(F.col("parent").alias("name"), (F.col("depth") - 1).alias("depth"))
    counted = nodes.join(children.agg(F.count("*").alias("n_children")), ["name", "depth"], "left")
    counted = counted.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    own = (F.col("n_convs") - 1) * F.col("words")
    leaf = F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(0)
    counted = counted.select("name", "depth", "parent", "n_convs", "n_children", leaf.alias("n_leaves"), own.alias("saved"))
    totals = _graft(stage(counted, "trie-counted"), names, rounds)

    # the root, from the sequences and the nodes of depth 1
    nil = F.lit(0).cast("long")
    none = F.lit(None).cast("long")
    members = sequences.select("seq", F.lit(1).cast("long").alias("one"), nil.alias("child"), nil.alias("n_leaves"), nil.alias("saved"))
    firsts = totals.where("depth = 1").select(none.alias("seq"), nil.alias("one"), F.lit(1).cast("long").alias("child"), "n_leaves", "saved")
    sums = [F.sum(c).alias(n) for c, n in (("one", "n_convs"), ("child", "n_children"), ("n_leaves", "n_leaves"), ("saved", "saved"))]
    root = members.unionByName(firsts).agg(F.min("seq").alias("conv_id"), *sums).where("conv_id is not null")
    root = root.select(
        nil.alias("name"), nil.alias("depth"), none.alias("parent"), "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved"
    )
    # a child of the root has the root's conversation as parent
    top = root.select(F.lit(1).cast("long").alias("depth"), F.col("conv_id").alias("top"))
    body = totals.withColumn("conv_id", F.col("name")).join(F.broadcast(top), "depth", "left")
    body = body.withColumn("parent", F.coalesce("parent", "top")).drop("top")
    every = body.unionByName(root)

    lengths = steps.groupBy("seq").agg(F.max("depth").alias("depth"))
    last = names.join(lengths, ["seq", "depth"]).select("name", "depth", "seq")
    empty = sequences.join(lengths, "seq", "left_anti").select(nil.alias("name"), nil.alias("depth"), "seq")
    ends = stage(end_digests(last.unionByName(empty)), "trie-ends")
    return every.join(ends, ["name", "depth"], "left").select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """Trie of the conversations as they are; ``columns`` as for :func:`turns`."""
    steps = stage(turns(conversations, **columns), "trie-turns")
    return prefix_trie(steps, steps.where("depth = 1").select("seq"))
