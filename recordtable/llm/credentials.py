"""Secret scan with multipart credential linking, in DataFrame functions only.

Base spans are found by pattern alone (``assign``, ``access``, ``hex``). Weak
parts are common in clean text and reported only in company: a credential is
an identifier, a secret and often an endpoint, so a weak part counts when the
complementary part is within ``scope`` code points of it:

* ``weak_id`` (user, client id, ...): a secret in scope;
* ``weak_secret`` (a short assigned value, a bare key of 40 characters or more): an identifier or an endpoint in scope;
* ``endpoint`` (a URL with a scheme): both an identifier and a secret in scope.

Identifiers are ``access`` and ``weak_id``, secrets are ``assign``, ``hex``
and ``weak_secret``.

The distance of two parts is the gap from the end of one to the start of the
other, so a long token or URL does not put its neighbours out of scope.
Parts meet by an interval join over cells of ``scope`` code points: each
part is summed up in the cells that it covers (for each class: first start
and last end), and a weak part asks the cells that its interval, widened by ``scope`` on
both sides, covers. In the first of them the last end decides, in the last one the first start, and any
part in those between is in scope, so the answer is exact. Sums
are partial aggregates; pairs of parts are never made, and parts of a kind do
not overlap, so a text full of parts costs time in proportion to its length.
A weak part inside a base span is no finding of its own: it is held against the
base spans of the cell in which it starts, of which there are at most some 70.

Defined results: null text counts as empty (no spans); repeated rows get equal
results; spans may overlap; positions are code points, ends exclusive; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, let, row_key, stage

SCOPE = 256

# Patterns of the parts.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
WEAK_ID = r"""(?i)(access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})"""
KEY_RUN = r"[A-Za-z0-9+/]{40,}"
ENDPOINT = r"""(?i)(https?|ftps?|ssh|s3|jdbc:[a-z]+|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20"'<>]+"""

#: Order of kinds in results: base kinds, then those that linking adds.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
IDENTIFIER, SECRET, END = 0, 1, 2
CLASS_OF = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, END)
LEAST_SECRET, LEAST_WEAK_SECRET = 12, 4

_CHUNK = 256

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Leftmost non-overlapping matches as ``array<struct<start, end, size>>``; size: length of the value group.

    A text is its gaps and matches in turn, so a match starts at the sum of the lengths before it. The sums
    run over chunks of matches, then inside each: an array grown by one copies itself, so none is long.
    """
    p = F.lit(pattern)
    whole = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(value_group))
    lengths = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.transform(whole, F.length).alias("match"),
        F.transform(value, F.length).alias("size"),
    )

    def chunked(all_: Column) -> Column:
        last = F.floor(F.size(all_) / _CHUNK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(all_, c * _CHUNK + 1, F.lit(_CHUNK)))

    def advance(acc: Column, x: Column) -> Column:
        return acc + x["gap"] + x["match"]

    def next_start(acc: Column, width: Column) -> Column:
        return F.struct((acc["at"] + width).alias("at"), F.concat(acc["found"], F.array(acc["at"])).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + x["match"]
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["size"].alias("size")))
        return F.struct(end.alias("at"), F.concat(acc["found"], one).alias("found"))

    def inside(chunk: Column, start: Column) -> Column:
        nothing = F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)")
        return F.aggregate(chunk, F.struct(start.alias("at"), nothing.alias("found")), add)["found"]

    def placed(chunks: Column) -> Column:
        widths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), advance))
        first = F.expr("struct(0 as at, cast(array() as array<int>) as found)")
        return F.flatten(F.zip_with(chunks, F.aggregate(widths, first, next_start)["found"], inside))

    # the last gap has no match: its fields are null
    return let(let(F.filter(lengths, lambda x: x["match"].isNotNull()), chunked), placed)


def _spans(found: Column, kind: str) -> Column:
    number = F.lit(KINDS.index(kind))
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), number.alias("kind"), x["end"].alias("end"))).cast(_SPAN)


def _none() -> Column:
    return F.expr(f"cast(array() as {_SPAN})")


def _parts(text: Column) -> tuple[Column, Column]:
    """(base spans, weak parts) of a text; the plain tests before the patterns are conditions of any match."""
    assigns = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    assign = _matches(text, ASSIGN, 2)
    base = F.concat(
        F.when(assigns, _spans(F.filter(assign, lambda x: x["size"] >= LEAST_SECRET), "assign")).otherwise(_none()),
        F.when(F.contains(text, F.lit("AKIA")), _spans(_matches(text, ACCESS), "access")).otherwise(_none()),
        F.when(text.rlike(HEX), _spans(_matches(text, HEX), "hex")).otherwise(_none()),
    )
    short = F.filter(assign, lambda x: (x["size"] >= LEAST_WEAK_SECRET) & (x["size"] < LEAST_SECRET))
    weak = F.concat(
        F.when(assigns, F.concat(_spans(_matches(text, WEAK_ID), "weak_id"), _spans(short, "weak_secret"))).otherwise(_none()),
        F.when(text.rlike(KEY_RUN), _spans(_matches(text, KEY_RUN), "weak_secret")).otherwise(_none()),
        F.when(F.contains(text, F.lit("://")), _spans(_matches(text, ENDPOINT), "endpoint")).otherwise(_none()),
    )
    return base, weak


def _in_cells(df: DataFrame, first: Column, last: Column, scope: int) -> DataFrame:
    """``df`` once for each cell from that of place ``first`` to that of place ``last``."""
    return df.withColumn("cell", F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope))))


def _own(each: DataFrame, scope: int) -> DataFrame:
    """``key, p`` without the weak parts that lie inside a base span."""
    weak_kind = F.col("p.kind") >= KINDS.index("weak_id")
    cells = _in_cells(each.where(~weak_kind), F.col("p.start"), F.col("p.end"), scope)
    bases = cells.groupBy("key", "cell").agg(F.collect_list("p").alias("bases"))  # of one cell: at most some 70
    weak = each.where(weak_kind).withColumn("cell", F.floor(F.col("p.start") / scope)).join(bases, ["key", "cell"], "left")
    inside = F.exists("bases", lambda b: (b["start"] <= F.col("p.start")) & (F.col("p.end") <= b["end"]))
    return weak.where(~F.coalesce(inside, F.lit(False))).select("key", "p")


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """``key, extra``: the weak parts of each text that have their complement in scope."""
    # repeated rows have one key and equal parts
    texts = parts.where(F.size("weak") > 0).select("key", "base", "weak").dropDuplicates(["key"])
    each = texts.select("key", F.explode(F.concat("base", "weak")).alias("p"))
    weak = stage(_own(each, scope), "secret-weak")
    base = texts.select("key", F.explode("base").alias("p"))

    class_of = F.element_at(F.array(*map(F.lit, CLASS_OF)), F.col("p.kind") + 1)
    covered = _in_cells(base.unionByName(weak), F.col("p.start"), F.col("p.end"), scope).withColumn("class", class_of)
    sums = []
    for c in (IDENTIFIER, SECRET, END):
        of_class = F.col("class") == c
        sums += [F.min(F.when(of_class, F.col("p.start"))).alias(f"first{c}"), F.max(F.when(of_class, F.col("p.end"))).alias(f"last{c}")]
    cells = covered.groupBy("key", "cell").agg(*sums)

    asked = _in_cells(weak, F.col("p.start") - scope, F.col("p.end") + scope, scope).join(cells, ["key", "cell"])

    def near(c: int) -> Column:
        close = (F.col(f"last{c}") >= F.col("p.start") - scope) & (F.col(f"first{c}") <= F.col("p.end") + scope)
        return F.coalesce(F.max(close), F.lit(False)).alias(f"near{c}")

    found = asked.groupBy("key", "p").agg(near(IDENTIFIER), near(SECRET), near(END))
    kind = F.col("p.kind")
    counts = (
        F.when(kind == KINDS.index("weak_id"), F.col(f"near{SECRET}"))
        .when(kind == KINDS.index("weak_secret"), F.col(f"near{IDENTIFIER}") | F.col(f"near{END}"))
        .when(kind == KINDS.index("endpoint"), F.col(f"near{IDENTIFIER}") & F.col(f"near{SECRET}"))
    )
    return found.where(counts).groupBy("key").agg(F.collect_set("p").alias("extra"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: ``<id_col>, row_key, base, spans``, the last two ``array<struct<start, kind, end>>``.

    ``kind`` is a place in :data:`KINDS`; spans are in order of start, kind, end.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    base, weak = _parts(F.col("text"))
    parts = stage(rows.select("id", "key", F.array_sort(base).alias("base"), weak.alias("weak")), "secret-parts")
    joined = join_hot(parts, _linked(parts, scope), "key", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("extra", _none())))
    return joined.select(F.col("id").alias(id_col), F.col("key").alias("row_key"), "base", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])))


def span_values(docs: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, kind, start, end, value``: the found texts of rows that have any."""
    some = scanned.where(F.size("spans") > 0).select("row_key", "spans").dropDuplicates(["row_key"])
    rows = docs.select(F.col(id_col), F.col(text_col).alias("__text"), row_key(docs, id_col, text_col).alias("row_key"))
    each = rows.join(some, "row_key").select(id_col, "__text", F.explode("spans").alias("s"))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("s.kind") + 1)
    value = F.substring(F.col("__text"), F.col("s.start") + 1, F.col("s.end") - F.col("s.start"))
    return each.select(id_col, name.alias("kind"), "s.start", "s.end", value.alias("value"))
