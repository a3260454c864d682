"""Best-fit packing of tokenised documents into sequences, certified by dual-feasible-function bounds.

1. Documents are tokenised and cut into pieces of at most ``capacity`` tokens
   (only a document's first piece can be shorter); a full piece is a sequence.
2. The other pieces are dealt to groups of about ``group_rows`` by hash; each
   group packs its pieces by best-fit decreasing and proves a lower bound on
   its number of sequences with dual feasible functions (DFF).
3. Full sequences are final. If the number of sequences with gaps equals the
   DFF bound over all their pieces (from their 1 to ``capacity`` size counts),
   the packing is certified and ends. Otherwise the groups with gaps exchange
   those pieces: they are dealt anew, to fewer groups, and packed again. A
   round that saves no sequence is dropped; ``PATIENCE`` such rounds in a row
   end the search.

Only (number, length) of a piece moves while packing. A group is bounded by
``group_rows`` whatever the data, so no task holds more; a piece's number is
unique, so no key is hot.

Defined results: null text is empty (one piece with the end token alone);
repeated rows and equal ids are packed once each; no documents give no
pieces; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.llm import bytebpe
from recordtable.llm.common import stage

CAPACITY = 1024
GROUP_ROWS = 100_000
MAX_ROUNDS = 12
PATIENCE = 2


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    encode = bytebpe.encoder(vocabulary).ids_of
    for b in batches:
        ids, text = b.column("__id"), b.column("__text")
        for at in range(0, b.num_rows, 128):
            rows, piece, start, length, tokens = [], [], [], [], []
            for i in range(at, min(at + 128, b.num_rows)):
                doc = np.array([*encode(text[i].as_py() or ""), end_id], dtype="<u4")
                cuts = range(len(doc) % capacity or capacity, len(doc) + 1, capacity)
                for n, stop in enumerate(cuts if len(doc) > capacity else [len(doc)]):
                    first = start[-1] + length[-1] if n else 0
                    rows.append(i)
                    piece.append(n)
                    start.append(first)
                    length.append(stop - first)
                    tokens.append(doc[first:stop].tobytes())
            yield pa.record_batch(
                {
                    "__id": ids.take(pa.array(rows, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids": pa.array(tokens, pa.binary()),
                }
            )


def tokenise(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents: ``<id_col>, piece, start, length, ids`` (ids: little-endian unsigned 32-bit, binary)."""
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    id_type = rows.schema["__id"].dataType.simpleString()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _pieces(batches, vocabulary, end_id, capacity)

    cut = rows.mapInArrow(pieces, f"__id {id_type}, piece int, start long, length long, ids binary")
    return cut.withColumnRenamed("__id", id_col)


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """Sequences needed at least for ``count[s]`` pieces of each length ``s`` (0 to capacity), by two DFF families.

    f_e: lengths over C - e count as C, lengths below e as 0, others as they are;
    u_k: floor((k+1) s / C) / k of a sequence, or s where (k+1) s / C is whole.
    """
    size = np.arange(capacity + 1)
    count = count.astype(object)  # exact sums
    total = int((count * size).sum())
    best = -(-total // capacity)
    for e in range(1, capacity // 2 + 1):
        over = int(count[capacity - e + 1 :].sum())
        rest = int((count * size)[e : capacity - e + 1].sum())
        best = max(best, over - (-rest // capacity))
    for k in range(1, 21):
        share, left = np.divmod((k + 1) * size, capacity)
        exact = int((count * size)[left == 0].sum())  # in tokens
        steps = int((count * share)[left != 0].sum())  # in k-ths of a sequence
        best = max(best, -(-(exact * k + steps * capacity) // (k * capacity)))
    return best


def best_fit(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset, order) of best-fit decreasing; ``order`` is the order in which pieces were placed."""
    order = np.argsort(-length, kind="stable")
    seq, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    open_by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, made = 0, 0  # bit s of spaces: a sequence with s free tokens is open
    for i, n in zip(order.tolist(), length[order].tolist(), strict=True):
        fits = spaces >> n
        if fits:
            space = n + (fits & -fits).bit_length() - 1
            at = open_by_space[space].pop()
            if not open_by_space[space]:
                spaces ^= 1 << space
        else:
            space, at, made = capacity, made, made + 1
        seq[i], offset[i] = at, capacity - space
        if space > n:
            open_by_space[space - n].append(at)
            spaces |= 1 << (space - n)
    return seq, offset, order


def _pack_group(table: pa.Table, capacity: int) -> pa.Table:
    number, length = table.column("number").to_numpy(), table.column("length").to_numpy()
    by = np.argsort(number)  # the result does not depend on the order of arrival
    number, length = number[by], length[by]
    seq, offset, _ = best_fit(length, capacity)
    fill = np.bincount(seq, weights=length).astype(np.int64)
    bound = lower_bound(np.bincount(length, minlength=capacity + 1), capacity)
    group = table.column("group")[0].as_py()
    return pa.table(
        {
            "number": number,
            "length": length,
            "group": np.full(len(seq), group, np.int64),
            "seq": seq,
            "offset": offset,
            "fill": fill[seq],
            "certified": np.full(len(seq), len(fill) == bound),
        }
    )


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    group_rows: int = GROUP_ROWS,
    max_rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``number, sequence_id, offset, certified`` for ``pieces(number long unique, length long)``.

    ``certified``: the group that packed the piece's sequence met its lower bound.
    """
    full = pieces.where(F.col("length") >= capacity).select(
        "number", (-1 - F.col("number")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("certified")
    )
    done, active, best, bound = [full], pieces.where(F.col("length") < capacity).select("number", "length"), None, 0
    kept: DataFrame | None = None
    idle = 0
    for turn in range(max_rounds):
        sizes = {r["length"]: r["n"] for r in active.groupBy("length").agg(F.count("*").alias("n")).collect()}
        rows = sum(sizes.values())  # at most capacity - 1 counts reach the driver
        if not rows:
            break
        bound = lower_bound(np.array([sizes.get(s, 0) for s in range(capacity + 1)], dtype=object), capacity)
        if best is not None and best == bound:
            break  # certified over all groups
        groups = math.ceil(rows / group_rows)
        dealt = active.withColumn("group", F.pmod(F.xxhash64("number", F.lit(turn)), F.lit(groups)).cast("long"))
        packed = dealt.groupBy("group").applyInArrow(
            lambda t: _pack_group(t, capacity),
            "number long, length long, group long, seq long, offset long, fill long, certified boolean",
        )
        name = (F.lit(turn) * (1 << 56) + F.col("group") * (1 << 28) + F.col("seq")).alias("sequence_id")
        packed = stage(packed.select("number", "length", name, "offset", "fill", "certified"), "packing-round")
        made = packed.where("offset = 0").agg(
            F.count("*").alias("all"), F.count(F.when(F.col("fill") < capacity, 1)).alias("gaps")
        ).first()
        if best is not None and made["all"] >= best:  # nothing saved: the earlier packing of these pieces stays
            idle += 1
            if idle == PATIENCE:
                break
            continue
        idle = 0
        final, kept = packed.where(F.col("fill") == capacity), packed.where(F.col("fill") < capacity)
        done.append(final.select("number", "sequence_id", "offset", "certified"))
        active, best = kept.select("number", "length"), made["gaps"]
    if kept is not None:
        certified = F.col("certified") | F.lit(best == bound)
        done.append(kept.select("number", "sequence_id", "offset", certified.alias("certified")))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 2,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_rows: int = GROUP_ROWS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``<id_col>, piece, start, length, ids, sequence_id, offset, certified``, one row per piece.

    ``carry`` replaces ``ids`` by other columns computed from a piece, so that
    a caller who needs a digest only does not move the tokens.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    cut = tokenise(docs, vocabulary, end_id, capacity, id_col, text_col)
    cut = cut.select(id_col, "piece", "start", "length", *[c.alias(n) for n, c in carry.items()])
    # the numbers are written, so every later read sees the same ones
    cut = stage(cut.withColumn("__number", F.monotonically_increasing_id()), "packing-pieces")
    placed = pack(cut.select(F.col("__number").alias("number"), "length"), capacity, group_rows)
    joined = cut.join(placed, cut["__number"] == placed["number"])
    return joined.select(id_col, "piece", "start", "length", *carry, "sequence_id", "offset", "certified")
