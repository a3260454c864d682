"""URL filter against the same models counted one gram at a time."""

import math
import zlib
from collections import defaultdict

import pytest
from cases import SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from recordtable.llm import urlfilter as U
from recordtable.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:at], rest[at:]
    at = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path[:at]


def whole(url):
    host = split(url)[0]
    return (url or "") if "://" not in (url or "") else url.split("://", 1)[0] + "://" + host + url.split("://", 1)[1][len(host) :]


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.rule), r.rule), default=None)


def brute(rows, rules, order=U.ORDER):
    def grams(text):
        c = [U.START] * order + list(text) + [U.END]
        return ["".join(c[i : i + order + 1]) for i in range(len(c) - order)]

    n, total, kinds = (defaultdict(lambda: [0, 0]) for _ in range(3))
    judged = [(i, *split(u), whole(u)) for i, u in rows]
    judged = [(i, h, p, u, rule_of(h, p, rules)) for i, h, p, u in judged]
    for _, _, _, u, r in judged:
        if r and zlib.crc32(u.encode()) % U.FOLDS:
            c = r.verdict == "block"
            for g in grams(u):
                for k in range(order + 1):
                    x = g[order - k :]
                    kinds[x[:-1], k][c] += not n[x][c]
                    n[x][c] += 1
                    total[x[:-1], k][c] += 1

    def prob(g, c):
        q = 1 / 256
        for k in range(order + 1):
            x = g[order - k :]
            t = kinds[x[:-1], k][c]
            if total[x[:-1], k][c]:
                q = (n[x][c] + t * q) / (total[x[:-1], k][c] + t)
        return q

    scores, bins = [], defaultdict(lambda: [0, 0])
    for _, _, _, u, r in judged:
        s = sum(round((math.log(prob(g, 0)) - math.log(prob(g, 1))) * 1e6) for g in grams(u)) / (len(u) + 1) / 1e6
        scores.append(s)
        if r and not zlib.crc32(u.encode()) % U.FOLDS:
            bins[math.floor(s * 1000)][r.verdict == "block"] += 1
    cut = U.threshold([(k, *v) for k, v in bins.items()])
    return {
        i: (h, p, r and r.rule, r.verdict if r else "allow" if math.floor(s * 1000) >= cut else "block", s)
        for (i, h, p, _, r), s in zip(judged, scores, strict=True)
    }


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_table(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    want = brute([(r.page_id, r.url) for r in pages.select("page_id", "url").collect()], URL_RULES)
    rows = U.judge_urls(pages, URL_RULES).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == want[r.page_id][:4]
        assert math.isclose(r.score, want[r.page_id][4], abs_tol=1e-6)


def test_parts_and_rules(spark):
    urls = [None, "", "no scheme", "http://A.B.Org/X?y#z", "x://Ö.ORG/", "http://h?q/r", "a://b://c/d", "http://", "http://noorg/x", "http://org/x#"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    rows = {r.page_id: r for r in U.judge_urls(df, URL_RULES).collect()}
    for i, u in enumerate(urls):
        host, path = split(u)
        r = rule_of(host, path, URL_RULES)
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, r and r.rule), u
        assert rows[i].verdict == (r.verdict if r else "allow")  # no blocked URL: nothing to compare with


def test_query_and_fragment_are_read(spark):
    urls = ["http://a.org/x"] * 1 + [f"http://b{i}.com/de/{i}?ref=spam" for i in range(40)] + [f"http://c{i}.org/{i}?ref=good" for i in range(40)]
    same = ["http://n.net/p?ref=spam", "http://n.net/p?ref=good", "HTTP://N.net/p#ref=good", None, "no scheme"]
    df = spark.createDataFrame(list(enumerate(urls + same)), "page_id int, url string")
    got = {r.page_id: r for r in U.judge_urls(df, URL_RULES).collect()}
    spam, good, other, null, plain = (got[len(urls) + i] for i in range(5))
    assert spam.score < good.score and other.score != good.score and null.score != plain.score
    assert {(r.host, r.path, r.rule) for r in (spam, good, other)} == {("n.net", "/p", None)}


def test_longest_rule_wins(spark):
    df = spark.createDataFrame([(1, "http://www.example.org/es/1"), (2, "http://example.org/en/12"), (3, "http://example.org/en/2")], "page_id int, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.judge_urls(df, URL_RULES).collect()}
    assert got == {1: ("example.org/es/", "block"), 2: ("example.org/en/1", "block"), 3: ("org/", "allow")}


def test_threshold():
    assert U.threshold([]) == 0
    assert U.threshold([(5, 3, 0)]) == 0
    assert U.threshold([(-10, 0, 4), (10, 6, 0)]) == 0  # the middle of the gap
    assert U.threshold([(-10, 0, 4), (0, 1, 5), (10, 6, 0)]) in range(1, 11)
    assert U.threshold([(0, 5, 0), (9, 0, 5)]) in (0, 10)  # upside down: all allowed or all blocked


def test_repeated_rows_clashing_names_and_empty(spark):
    df = spark.createDataFrame([(1, "http://a.org/", "x", 1, 2, 3)] * 3 + [(None, None, None, None, None, None)], "page_id int, url string, host string, text int, score int, gram int")
    assert U.judge_urls(df, URL_RULES).count() == 4
    assert U.judge_urls(df.limit(0), URL_RULES).count() == 0
    assert U.judge_urls(df, ()).select(F.min("verdict")).first()[0] == "allow"


def test_very_long_url(spark):
    df = spark.createDataFrame([(1, "http://a.org/" + "x/" * 8_000), (2, "http://b.com/de/y"), (3, "http://c.net/" + "😀z" * 1000)], "page_id int, url string")
    assert {r.page_id: r.verdict for r in U.judge_urls(df, URL_RULES).where("page_id < 3").collect()} == {1: "allow", 2: "block"}
