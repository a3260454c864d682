"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: numbers, names (capitalised
words) and units (unit words after a number) are typed placeholders, other
words are case-folded. A capitalised word that starts a sentence or line, or
follows a colon, may be a name or not: windows are hashed with every choice of
the two readings (``k`` such words in a window make at most ``2**k`` hashes),
so a window matches whatever stands before it. Windows of
``window`` template tokens of documents and benchmark items are hashed and
joined; for a joined window the values in its placeholders are compared. It
matches if each of the item's values in it has one value in the document's (3
and 4 may both become 5): a verbatim window always does, whatever stands
around it.

A match is at least ``window`` (10) template tokens long, or a whole item that
is shorter; documents are searched at those items' lengths too. An item of
fewer than ``SHORT_ITEM`` (4) template tokens names nothing in particular: it
matches only a document that has no other tokens.

A window with fewer than ``min_literals`` ordinary words would match by
placeholders alone; it matches where all its words, numbers and names are the
same but for case.

Whole texts are read in tasks (Arrow batches). A window is hashed only if all
its neighbouring tokens, in some reading, are neighbours in the benchmark too, by a
bit table of fixed size that never says no wrongly; its hash then passes a second
such table, built from the benchmark's windows, and what passes is
hash-joined by Spark. Nothing else of either side is broadcast or collected.

Defined results: null and empty texts match nothing; repeated rows give the same
result; rows of equal id are reported once per id and item; other columns
are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.llm.common import remove_rows, row_key, stage

WINDOW = 10
MIN_LITERALS = 5
SHORT_ITEM = 4
#: log2 of the slots of each of the two bit tables (2**22 slots: 4 MB in a task).
TABLE_BITS = 22
#: Stretches of windows to hash that are closer than this are taken together.
STRETCH = 64
#: Characters of documents whose tokens are worked on together (a longer document by itself).
READ_CHARACTERS = 1 << 18

# Unit words and signs, read as units only after a number.
UNITS = frozenset(
    """% ° $ € £ mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t oz lb lbs pound pounds
    gram grams kilogram kilograms ton tons ml cl dl l liter liters litre litres gallon gallons cup cups
    ms s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
    k c f kelvin celsius fahrenheit w kw mw watt watts v volt volts a amp amps hz khz mhz ghz j kj cal kcal
    kb mb gb tb byte bytes bit bits mph kph km/h usd eur gbp dollar dollars euro euros cent cents percent
    degree degrees meter meters metre metres kilometer kilometers kilometre kilometres""".split()
)

#: Signs stripped from both ends of a white-space token; a number keeps its currency or per cent sign.
OUTER = "".join(c for c in string.punctuation if c not in "%$") + "“”„‘’«»‹›¿¡…–—·•"
WORD, NUMBER, UNIT, CAPITALISED, NOTHING = range(5)
#: Set beside the kind of a token that ends a sentence or introduces one.
STOP = 8
#: Entries of a task's word table; a fuller one is emptied, which costs time only.
WORD_TABLE = 1 << 19


_STOPS = frozenset(".!?:")
_HIGH = (1 << 64) - 16


class _Words(dict):
    """Token as it stands -> 60-bit hash of its case-folded word, with kind and STOP in the low 4 bits."""

    def __missing__(self, token: str) -> int:
        if token.islower() and token.isalpha():  # most tokens
            kind = UNIT if token in UNITS else WORD
            value = self[token] = xxhash.xxh3_64_intdigest(token) & _HIGH | kind
            return value
        word = token.strip(OUTER)
        folded = word.lower()
        if word.isalpha():
            if folded in UNITS:
                kind = UNIT
            else:
                kind = CAPITALISED if folded[0] != word[0] and word[1:] == folded[1:] else WORD
        elif not word:
            kind = NOTHING
        elif folded in UNITS:
            kind = UNIT
        else:
            kind = NUMBER if word.lstrip("$€£+-")[:1].isdigit() else WORD
        if not _STOPS.isdisjoint(token[len(token.rstrip(OUTER)) :]):
            kind |= STOP
        value = self[token] = xxhash.xxh3_64_intdigest(folded.encode("utf-8", "surrogatepass")) & _HIGH | kind
        return value


_PLACEHOLDER = np.array([0, 1, 2, 3], dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def template(tokens: list[str], words: _Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template hashes, literal flags, places in ``tokens``) of white-space tokens, bare punctuation left out."""
    return _template(tokens, words, [])[:3]


def _template(tokens: list[str], words: _Words, lines: list[int], texts: list[int] | None = None) -> tuple[np.ndarray, ...]:
    """As :func:`template`, flags of literals that may be names, and word hashes.

    ``lines``: places that start a line; ``texts``: places that start another text, whose tokens see none before.
    """
    value = np.fromiter(map(words.__getitem__, tokens), dtype=np.uint64, count=len(tokens))
    low = (value & np.uint64(15)).astype(np.int8)
    kind, starts = low & 7, np.ones(len(tokens), dtype=bool)
    starts[1:] = low[:-1] >= STOP
    starts[lines] = True
    slot = np.zeros(len(tokens), dtype=np.int8)
    slot[kind == NUMBER] = 1
    slot[1:][(kind[1:] == UNIT) & (low[:-1] == NUMBER)] = 2
    if texts:
        slot[[t for t in texts if t < len(tokens) and slot[t] == 2]] = 0
    at = np.nonzero(kind != NOTHING)[0]
    slot, capitalised = slot[at], kind[at] == CAPITALISED
    # bare punctuation between a start and a word leaves it a start
    maybe = capitalised & (np.diff(np.cumsum(starts)[at], prepend=0) > 0)
    slot[capitalised & ~maybe] = 3
    word = value[at] >> np.uint64(4) << np.uint64(4)
    return np.where(slot > 0, _PLACEHOLDER[slot], word), slot == 0, at, maybe, word


def _lines(text: str) -> tuple[list[str], list[int]]:
    """(white-space tokens, places of those that start a line)."""
    tokens: list[str] = []
    starts = []
    for line in text.splitlines():
        new = line.split()
        if new:
            starts.append(len(tokens))
            tokens += new
    return tokens, starts


def windows(hashed: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` template tokens."""
    return _mix(_sums(hashed, size), size)


def _sums(hashed: np.ndarray, size: int) -> np.ndarray:
    """Polynomial of every window, put together from power-of-two widths."""
    if len(hashed) < size:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        # power: sums of windows of ``width`` tokens; total: of the ``done`` tokens put together so far
        power, width, base = hashed, 1, _BASE
        total, done = np.zeros(len(hashed) + 1, dtype=np.uint64), 0
        while True:
            if size & width:
                n = len(hashed) - done - width + 1
                total, done = total[:n] * base + power[done : done + n], done + width
            if 2 * width > size:
                break
            power, base = power[:-width] * base + power[width:], base * base
            width *= 2
        return total


def _mix(total: np.ndarray, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = total ^ np.uint64(size)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(32)


#: Windows with doubtful words that are read at a time: at most this many times 2**size hashes are held.
READ_AT_ONCE = 512


def _readings(
    hashed: np.ndarray, literal: np.ndarray, maybe: np.ndarray, size: int, min_literals: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places, hashes, names) of windows in every reading that has ``min_literals``; names: bits of literals read as names."""
    total = _sums(hashed, size)
    if not len(total):
        return
    before = np.concatenate([[0], np.cumsum(literal)])
    spare = before[size:] - before[:-size] - min_literals
    at = np.nonzero(spare >= 0)[0]
    yield at, _mix(total[at], size), np.zeros(len(at), dtype=object if size > 63 else np.int64)
    before = np.concatenate([[0], np.cumsum(maybe)])
    doubtful = np.nonzero((spare > 0) & (before[size:] > before[:-size]))[0]
    weight = [pow(int(_BASE), size - 1 - o, 1 << 64) for o in range(size)]
    with np.errstate(over="ignore"):
        change = np.where(maybe, _PLACEHOLDER[3] - hashed, np.uint64(0))
        for i in range(0, len(doubtful), READ_AT_ONCE):
            at = doubtful[i : i + READ_AT_ONCE]
            first, left, sums = len(at), spare[at], total[at]
            names = np.zeros(len(at), dtype=object if size > 63 else np.int64)
            for o in range(size):
                m = np.nonzero(maybe[at + o] & (left > 0))[0]
                if len(m):
                    sums = np.concatenate([sums, sums[m] + change[at[m] + o] * np.uint64(weight[o])])
                    names = np.concatenate([names, names[m] | 1 << o])
                    left = np.concatenate([left, left[m] - 1])
                    at = np.concatenate([at, at[m]])
            yield at[first:], _mix(sums[first:], size), names[first:]


#: Keeps hashes of windows of words from meeting those of templates.
_VERBATIM = np.uint64(0xA5A5A5A5A5A5A5A5)


def _verbatim(word: np.ndarray, literal: np.ndarray, maybe: np.ndarray, size: int, below: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes of all words) of windows that have fewer than ``below`` literals in some reading."""
    h = windows(word, size) ^ _VERBATIM
    sure = np.concatenate([[0], np.cumsum(literal & ~maybe)])
    at = np.nonzero(sure[size:] - sure[:-size] < below)[0] if len(h) else np.arange(0)
    return at, h[at]


def _slot(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - TABLE_BITS)


def _pairs(hashed: np.ndarray, maybe: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, hashes) of neighbouring tokens in each reading."""
    yield np.arange(max(0, len(hashed) - 1)), windows(hashed, 2)
    named = np.where(maybe, _PLACEHOLDER[3], hashed)
    at = np.nonzero(maybe[:-1] | maybe[1:])[0]
    if len(at):
        with np.errstate(over="ignore"):
            for a, b in ((named, hashed), (hashed, named), (named, named)):
                yield at, _mix(a[at] * _BASE + b[at + 1], 2)


def _stretches(known: np.ndarray, size: int, text: np.ndarray, length: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of runs of windows in which all pairs may be known, near ones of a text taken together.

    ``text``: number of each token's text; ``length``: tokens of each text. Windows below ``SHORT_ITEM`` must be a whole text.
    """
    count = np.concatenate([[0], np.cumsum(known)])
    at = np.nonzero(count[size - 1 :] - count[: len(count) - size + 1] == size - 1)[0]
    if size < SHORT_ITEM:
        at = at[length[text[at]] == size]
    if not len(at):
        return []
    cut = np.nonzero((np.diff(at) > STRETCH) | (np.diff(text[at]) > 0))[0]
    first, last = at[np.concatenate([[0], cut + 1])], at[np.concatenate([cut, [len(at) - 1]])]
    return list(zip(first.tolist(), (last + 1).tolist(), strict=True))


def _groups(text: pa.Array, size: int) -> Iterator[list[int]]:
    """Rows of a batch, as many at a time as have ``size`` characters, one at least."""
    rows: list[int] = []
    total = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(text), 0).to_pylist()):
        if rows and total + n > size:
            yield rows
            rows, total = [], 0
        rows.append(i)
        total += n
    if rows:
        yield rows


def _known_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slots of the benchmark's pairs of neighbouring tokens, of templates and of words."""
    words = _Words()
    for b in batches:
        slots = [np.empty(0, np.int64)]
        for t in b.column("__text"):
            tokens, lines = _lines(t.as_py() or "")
            hashed, _, _, maybe, word = _template(tokens, words, lines)
            slots += [_slot(h).astype(np.int64) for _, h in _pairs(hashed, maybe)]
            slots.append(_slot(windows(word, 2)).astype(np.int64))
        yield pa.record_batch({"s": pa.array(np.unique(np.concatenate(slots)), pa.int64())})


def _windows(
    batches: Iterator[pa.RecordBatch],
    window: int,
    min_literals: int,
    short: list[int] | None,
    bits: np.ndarray | None,
    pair_bits: np.ndarray | None,
) -> Iterator[pa.RecordBatch]:
    """Windows of each row: (row, size, hash, position, slot values). ``short``: sizes to search for besides.

    Without ``short`` the rows are benchmark items: those below ``window`` are one window of their own length.
    Windows that may lack ``min_literals`` come with the hash of their words too, without slot values.
    """
    words = _Words()
    table = None if bits is None else np.unpackbits(bits).astype(bool)
    pairs = None if pair_bits is None else np.unpackbits(pair_bits).astype(bool)
    for b in batches:
        ids, text = b.column("__row"), b.column("__text")
        out: dict[str, list] = {"row": [], "size": [], "h": [], "pos": [], "slots": []}
        # benchmark items are read one by one, documents some at a time: their tokens stand one after the other
        for rows in [[i] for i in range(b.num_rows)] if short is None else _groups(text, READ_CHARACTERS):
            tokens: list[str] = []
            lines, begin = [], []
            for i in rows:
                begin.append(len(tokens))
                new, starts = _lines(text[i].as_py() or "")
                lines += [len(tokens) + n for n in starts] if tokens else starts
                tokens += new
            hashed, literal, place, maybe, word = _template(tokens, words, lines, begin)
            if len(words) > WORD_TABLE:
                words.clear()
            first_of = np.searchsorted(place, begin)
            length = np.diff(first_of, append=len(hashed))
            of = np.repeat(np.arange(len(rows)), length)
            known = same = np.ones(max(0, len(hashed) - 1), dtype=bool)
            if pairs is not None:
                known = np.zeros(max(0, len(hashed) - 1), dtype=bool)
                for at, h in _pairs(hashed, maybe):
                    known[at] |= pairs[_slot(h)]
                same = pairs[_slot(windows(word, 2))]
            apart = np.nonzero(np.diff(of))[0]  # no window spans two texts
            known[apart] = same[apart] = False
            for size in [min(window, len(hashed)) or 1] if short is None else [window, *short]:
                if len(hashed) < size:
                    continue
                whole = [(0, len(hashed) - size + 1)]
                for first, end in whole if short is None else _stretches(known, size, of, length):
                    part, row = slice(first, end + size - 1), int(of[first])
                    for at, h, names in _readings(hashed[part], literal[part], maybe[part], size, min_literals):
                        hits = range(len(at)) if table is None else np.nonzero(table[_slot(h)])[0].tolist()
                        for k in hits:
                            p, named = first + int(at[k]), int(names[k])
                            out["row"].append(rows[row])
                            out["size"].append(size)
                            out["h"].append(h[k].view(np.int64))
                            out["pos"].append(p - int(first_of[row]))
                            slots = [place[p + o] for o in range(size) if not literal[p + o] or named >> o & 1]
                            out["slots"].append([tokens[q].strip(OUTER) for q in slots])
                for first, end in whole if short is None else _stretches(same, size, of, length):
                    part, row = slice(first, end + size - 1), int(of[first])
                    # a document's reading of the same words may have fewer literals or more: all its windows are looked up
                    below = min_literals if short is None else size + 1
                    at, h = _verbatim(word[part], literal[part], maybe[part], size, below)
                    hits = range(len(at)) if table is None else np.nonzero(table[_slot(h)])[0].tolist()
                    for k in hits:
                        out["row"].append(rows[row])
                        out["size"].append(size)
                        out["h"].append(h[k].view(np.int64))
                        out["pos"].append(first + int(at[k]) - int(first_of[row]))
                        out["slots"].append([])
        yield pa.record_batch(
            {
                "row": ids.take(pa.array(out["row"], pa.int64())),
                "size": pa.array(out["size"], pa.int32()),
                "h": pa.array(out["h"], pa.int64()),
                "pos": pa.array(out["pos"], pa.int32()),
                "slots": pa.array(out["slots"], pa.list_(pa.string())),
            }
        )


def _window_rows(df: DataFrame, row: Column, text_col: str, *options) -> DataFrame:
    rows = df.select(row.alias("__row"), F.col(text_col).alias("__text"))
    kind = rows.schema["__row"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _windows(batches, *options)

    return rows.mapInArrow(cut, f"row {kind}, size int, h long, pos int, slots array<string>")


def _bit_table(slots: DataFrame) -> np.ndarray:
    """Packed bits of ``slots(s)``: at most 2**TABLE_BITS numbers reach the driver, tasks get 512 KB."""
    table = np.zeros(1 << TABLE_BITS, dtype=bool)
    table[slots.distinct().toPandas()["s"].to_numpy(dtype=np.int64)] = True
    return np.packbits(table)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
) -> DataFrame:
    """One row per contaminated document row and item: ``<id_col>, <item_col>, row_key, matched_windows, first_token, changed``.

    ``first_token``: template token at which the item's first match begins;
    ``changed``: some placeholder's value differs (a re-parameterised copy).
    """
    items = _window_rows(benchmark, F.col(item_col), item_text_col, window, min_literals, None, None, None)
    items = stage(items, "leak-items")
    neighbours = benchmark.select(F.col(item_text_col).alias("__text")).mapInArrow(_known_pairs, "s long")
    bits = _bit_table(items.select(F.shiftrightunsigned("h", 64 - TABLE_BITS).alias("s")))
    pair_bits = _bit_table(neighbours)
    short = [r["size"] for r in items.where(F.col("size") < window).select("size").distinct().collect()]

    row = F.struct(F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("key"))
    found = _window_rows(docs, row, text_col, window, min_literals, short, bits, pair_bits)
    found = stage(found.select("row.id", "row.key", "size", "h", "pos", "slots").distinct(), "leak-windows")

    known = items.select(F.col("row").alias("item"), "size", "h", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    pairs = found.join(known.distinct(), ["size", "h"])
    # equal windows have the same placeholders in the same places: values pair up by position
    pairs = pairs.select(
        "id", "key", "item", "pos", "size", (F.col("pos") - F.col("item_pos")).alias("shift"), F.arrays_zip("item_slots", "slots").alias("values")
    )
    changed = F.exists("values", lambda v: v["item_slots"] != v["slots"])
    item_values = F.size(F.array_distinct(F.transform("values", lambda v: v["item_slots"])))
    at = ["id", "key", "item", "shift"]
    # each value of the item has one value in the document's window; two may have the same
    fits = pairs.where(item_values == F.size(F.array_distinct("values"))).withColumn("changed", changed)
    each = fits.groupBy(*at, "pos").agg(F.min("changed").alias("changed"))
    matched = each.groupBy(*at).agg(F.count("*").alias("matched_windows"), F.min("pos").alias("first_token"), F.max("changed").alias("changed"))
    return (
        matched.groupBy("id", "key", "item")
        .agg(F.sum("matched_windows").alias("matched_windows"), F.min("first_token").alias("first_token"), F.min("changed").alias("changed"))
        .select(F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("key").alias("row_key"), "matched_windows", "first_token", "changed")
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated rows; all columns stay."""
    leaks = find_leaks(docs, benchmark, id_col, text_col, **options)
    removed = leaks.select(F.col("row_key").alias("__key"), F.lit(0).alias("__keep")).distinct()
    return remove_rows(docs, stage(removed, "leak-removed"), id_col, text_col)
