"""Search, listing and grouping under collations."""

import pytest

from conftest import rows
from recordtable.operators.read import find, group_stats, list_rows

NAMES = ["Straße", "İstanbul", "istanbul", "Éa", "ea", "eA", None, "STRASSE", "a%b", "zebra Crème brûlée", "créme", "ΟΔΟΣ", "οδος"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(list(enumerate(NAMES)), "k int, n string")


def _found(table, text, collation, mode="like"):
    return [r.n for r in find(table, "n", text, mode, cols=["n"], order=False, collation=collation).collect()]


def test_find(table):
    assert set(_found(table, "EA", "UTF8_LCASE")) == {"ea", "eA"}
    assert set(_found(table, "E_", "UTF8_LCASE")) >= {"ea", "eA"}
    assert set(_found(table, "ea", "UNICODE_CI_AI", "literal")) == {"Éa", "ea", "eA"}
    assert set(_found(table, "CREME", "UNICODE_CI_AI")) == {"zebra Crème brûlée", "créme"}
    assert set(_found(table, "strass", "UNICODE_CI_AI")) == {"Straße", "STRASSE"}
    assert set(_found(table, "istan", "tr_CI")) == {"İstanbul", "istanbul"}  # dotted I
    assert _found(table, "istan", "UNICODE_CI") == ["istanbul"]
    assert len(_found(table, "", "UNICODE_CI_AI")) == len(NAMES) - 1


def test_find_parts_in_order(table):
    assert _found(table, "CREME%brulee", "UNICODE_CI_AI") == ["zebra Crème brûlée"]
    assert _found(table, "brulee%creme", "UNICODE_CI_AI") == []
    assert _found(table, "e%e%e%e%e", "UNICODE_CI_AI") == ["zebra Crème brûlée"]
    assert _found(table, "e%e%e%e%e%e", "UNICODE_CI_AI") == []
    assert set(_found(table, "strass%e", "UNICODE_CI_AI")) == {"Straße", "STRASSE"}  # the match of a part may be shorter
    assert _found(table, "%%", "UNICODE_CI_AI", "like") == [n for n in NAMES if n is not None]
    assert _found(table, "a%b", "UNICODE_CI_AI", "literal") == ["a%b"]


def test_refused(table):
    with pytest.raises(ValueError, match="wildcard _"):
        _found(table, "a_", "UNICODE_CI")
    with pytest.raises(ValueError, match="own rule"):
        find(table, "n", "a", ignore_case=True, collation="UNICODE_CI")
    with pytest.raises(ValueError, match="unknown find mode"):
        _found(table, "a", "UNICODE_CI", "regex")


def test_list_and_stats(table):
    listed = [r.n for r in list_rows(table, ["n", "k"], ["n"], 6, key="k", collation="UNICODE_CI_AI").collect()]
    assert listed == [None, "a%b", "créme", "Éa", "ea", "eA"]  # ties by key
    longer = list_rows(table, ["n", "k"], ["n"], 6, key="k", top_n=2, collation="UNICODE_CI_AI")
    assert [r.n for r in longer.collect()] == listed
    groups = {r.n: (r.c, r.avg_k) for r in group_stats(table, "n", ["k"], "c", collation="UNICODE_CI_AI").collect()}
    assert groups["eA"] == (3, 4.0) and groups["STRASSE"] == (2, 3.5) and groups["istanbul"] == (2, 1.5) and groups[None] == (1, 6.0)
    by_bytes = group_stats(table, "n", ["k"], "c")
    assert len(groups) == 8 and by_bytes.count() == len(NAMES)
    assert rows(group_stats(table, "n", ["k"], "c", collation="UTF8_BINARY")) == rows(by_bytes)
