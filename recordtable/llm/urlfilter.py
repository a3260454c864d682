"""URL filter: rules first, then the ratio of two character language models.

URLs that a rule decides are the labelled set. Two smoothed variable-order
Markov models, one of allowed and one of blocked URLs, are counted over four
fifths of them (by hash of the URL); every URL gets the difference of the two
log-likelihoods divided by its length. The threshold is calibrated on all of
the last fifth, which the models have not seen: the cut with the least sum of
the two error rates, in the middle of the widest gap of equal cuts. URLs that
no rule decides are allowed if their score is not below it.

Model. A URL's characters are all of it, scheme, query and fragment too, with the host
in lower case, after ``ORDER`` start marks and before an end mark. The probability of a character after a context of
length k mixes its share there with the shorter context's probability
(Witten-Bell): ``(n + t * p_shorter) / (total + t)``, t being the number of
different characters seen in the context; a context never seen leaves the
shorter one's value, and the shortest falls back to 1 / alphabet. So the order
that counts varies with what was seen.

Spark side. Grams of ``ORDER + 1`` characters are counted once over all URLs;
shorter orders are sums of that table; each order's probabilities come from
the next shorter one's by one join. URLs are scored by joining their grams
with the table of log ratios, kept as whole millionths so that sums do not
depend on the order of rows. Nothing that grows with the data is broadcast or
collected; the calibration histogram has at most ``2 * SCORE_BINS + 1`` bins.

Defined results: null or no ``://``: host and path are empty, no rule fits and
the method judges the URL as it stands (null: the empty string); equal URLs are scored once and get equal
verdicts; a class without training URLs leaves no ratio: then every URL
without a rule is allowed, with a null score; a class without URLs to
calibrate on leaves the cut at 0 (equally likely); other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, let, stage

ORDER = 4
START, END = "\u0002", "\u0003"
MILLION = 1_000_000
#: One in so many of the labelled URLs is kept for calibration.
FOLDS = 5
#: Scores are binned by thousandths for calibration, from -30 to 30.
SCORE_BINS = 30_000


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host (with its subdomains) and the start of a path."""

    verdict: str
    rule: str

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.expr("substring(__url, locate('://', __url) + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def whole_text(url: Column, host: Column) -> Column:
    """The whole URL, its host (as :func:`host_and_path` gives it) in lower case; empty for null."""
    at = F.locate("://", url)
    before = F.substring(url, 1, at + 2)
    lowered = F.concat(before, host, F.substring(url, at + 3 + F.length(host), F.length(url)))
    return F.coalesce(F.when(at > 0, lowered).otherwise(url), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct<size, rule, verdict>`` of the longest rule that fits, or null."""
    fitting = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.rule)).alias("size"), F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fitting)) if fitting else F.expr("cast(null as struct<size:int,rule:string,verdict:string>)")


def grams(text: Column, order: int = ORDER) -> Column:
    """All runs of ``order + 1`` characters of the marked text, one for each character and the end."""
    chars = F.concat(F.array_repeat(F.lit(START), order), F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), F.array(F.lit(END)))

    def runs(c: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(c) - order), lambda i: F.array_join(F.slice(c, i, order + 1), ""))

    return let(chars, runs)


def gram_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``gram, ratio``: log p(last | rest) of allowed less that of blocked URLs, in millionths.

    ``counts(gram, allow, block)``: every gram of any URL with its counts in the training URLs.
    """
    alphabet = F.lit(1.0) / F.lit(1 << 8)
    shorter: DataFrame | None = None
    for k in range(order + 1):
        level = counts.groupBy(F.right(F.col("gram"), F.lit(k + 1)).alias("g")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))
        # a context is followed by the alphabet's characters at most, so these groups are small
        same = Window.partitionBy("context")
        level = level.withColumn("context", F.substring("g", 1, k))
        for c in ("allow", "block"):
            level = level.withColumn(f"total_{c}", F.sum(c).over(same)).withColumn(
                f"kinds_{c}", F.sum(F.when(F.col(c) > 0, 1).otherwise(0)).over(same)
            )
        if shorter is None:
            level = level.withColumn("p_allow", alphabet).withColumn("p_block", alphabet)
        else:
            level = level.withColumn("__tail", F.right(F.col("g"), F.lit(k))).join(shorter, "__tail")
        for c in ("allow", "block"):
            seen = F.col(f"total_{c}") + F.col(f"kinds_{c}")
            mixed = (F.col(c) + F.col(f"kinds_{c}") * F.col(f"p_{c}")) / seen
            level = level.withColumn(f"q_{c}", F.when(seen > 0, mixed).otherwise(F.col(f"p_{c}")))
        # one round of shuffles per order: each level is written, not computed again by the next
        level = stage(level.select("g", "q_allow", "q_block"), "url-model")
        shorter = level.select(F.col("g").alias("__tail"), F.col("q_allow").alias("p_allow"), F.col("q_block").alias("p_block"))
    ratio = F.round((F.log("q_allow") - F.log("q_block")) * MILLION).cast("long")
    return level.select(F.col("g").alias("gram"), ratio.alias("ratio"))


def threshold(bins: list[tuple[int, int, int]]) -> int:
    """Least bin allowed, from ``bins`` of (bin, allowed URLs, blocked URLs): see the module's text."""
    allow, block = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not allow or not block:
        return 0
    bins = sorted(bins)
    below_allow = below_block = 0
    cuts = []  # (cost, -gap, cut): everything below the cut is blocked
    for n, (at, a, b) in enumerate(bins):
        cost = below_allow * block + (block - below_block) * allow
        before = bins[n - 1][0] + 1 if n else at
        cuts.append((cost, before - at, (before + at) // 2))
        below_allow, below_block = below_allow + a, below_block + b
    cuts.append((below_allow * block + (block - below_block) * allow, 0, bins[-1][0] + 1))
    return min(cuts)[2]


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", order: int = ORDER
) -> DataFrame:
    """One row per input row: ``<id_col>, host, path, rule, verdict, score``."""
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("__id", host.alias("host"), path.alias("path"), "__url")
    rows = rows.withColumn("text", whole_text(F.col("__url"), F.col("host"))).drop("__url")
    rows = rows.withColumn("__m", matched_rule(F.col("host"), F.col("path"), rules))
    rows = rows.select("__id", "host", "path", "__m.rule", F.col("__m.verdict").alias("ruled"), "text")
    rows = stage(rows, "url-rows")

    texts = rows.groupBy("text").agg(
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allow"), F.count(F.when(F.col("ruled") == "block", 1)).alias("block")
    )
    unseen = F.crc32(F.col("text").cast("binary")) % FOLDS == 0
    texts = stage(texts.withColumn("unseen", unseen), "url-texts")
    # grams are many times the bytes of their URLs: URLs are dealt out before
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = texts.repartition(parts).select("text", "unseen", "allow", "block", F.explode(grams(F.col("text"), order)).alias("gram"))
    learned = [F.sum(F.when(F.col("unseen"), 0).otherwise(F.col(c))).alias(c) for c in ("allow", "block")]
    counts = stage(each.groupBy("gram").agg(*learned), "url-grams")
    trained = counts.agg(F.max("allow"), F.max("block")).first()
    ratios = gram_ratios(counts, order)

    length = F.length("text") + 1
    summed = each.join(ratios, "gram").groupBy("text").agg(F.sum("ratio").alias("ratio"))
    scored = join_hot(texts, summed, "text").withColumn("score", F.col("ratio") / length / MILLION)
    scored = stage(scored, "url-scores")
    at = F.least(F.greatest(F.floor(F.col("score") * 1000), F.lit(-SCORE_BINS)), F.lit(SCORE_BINS)).cast("int")
    bins = scored.where("unseen and allow + block > 0").groupBy(at.alias("bin"))
    found = [(r["bin"], r["a"], r["b"]) for r in bins.agg(F.sum("allow").alias("a"), F.sum("block").alias("b")).collect()]

    out = join_hot(rows, scored.select("text", "score", at.alias("bin")), "text")
    if not trained[0] or not trained[1]:
        judged, score = F.lit("allow"), F.lit(None).cast("double")
    else:
        judged, score = F.when(F.col("bin") >= threshold(found), "allow").otherwise("block"), F.col("score")
    return out.select(
        F.col("__id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), score.alias("score")
    )
