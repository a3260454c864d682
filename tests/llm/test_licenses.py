"""Licence scan: variants of known texts, and near misses."""

import re
import textwrap

import duckdb
from cases import awkward, nothing  # noqa: F401

from recordtable.llm import licenses as L
from recordtable.llm.queries import SQL_LICENSES, q_licenses

TEXT = {i: t for i, _, t in L.TEXTS}


def scan(spark, texts, known=None):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: (r.license_id, r.notices) for r in L.scan_licenses(df, known).collect()}


def test_known_texts_in_other_dress(spark):
    texts = [
        TEXT["MIT"],
        "The MIT License\n\nCopyright (c) 2021 A. Person\n\n" + TEXT["MIT"],
        "mit licence\n(C) 1999 X\nAll rights reserved.\n" + TEXT["MIT"].replace("\n", " ").replace('"', "'").upper(),
        " * " + TEXT["BSD-3-Clause"].replace("\n", "\n * ").replace("HOLDER", "OWNER"),
        TEXT["ISC"] + "\nCopyright 2020",
        TEXT["Unlicense"].replace("https", "http").replace("non-commercial", "noncommercial"),
    ]
    ids = ["MIT", "MIT", "MIT", "BSD-3-Clause", "ISC", "Unlicense"]
    assert scan(spark, texts) == {n: (i, []) for n, i in enumerate(ids)}


def test_known_texts_at_any_width(spark):
    texts, want = [], []
    for i, text in TEXT.items():
        for width in range(12, 110, 3):
            texts.append("Copyright (c) 2020 A. Person\nCopyright The Authors\n\n" + "\n".join(textwrap.wrap(text, width, break_on_hyphens=False, break_long_words=False)))
            want.append((i, []))
    texts.append(" * " + TEXT["MIT"].replace(" COPYRIGHT ", "\n * COPYRIGHT\n * "))
    want.append(("MIT", []))
    assert scan(spark, texts) == dict(enumerate(want))


def test_near_misses(spark):
    texts = [TEXT["MIT"] + " And one more word.", TEXT["MIT"].replace("free of charge", "for a fee"), TEXT["MIT"][:-20], "Some MIT licensed thing"]
    assert scan(spark, texts) == {n: (None, []) for n in range(4)}


def test_notices_are_whole_lines(spark):
    texts = [
        "Prose.\nReleased under the MIT License.\nMore.\nreleased under the MIT licence",
        "# SPDX-License-Identifier: Apache-2.0\nx = 1\n// Licensed under CC BY-NC 4.0.",
        "Prose that says it is Released under the MIT License. And goes on.",
        "Released under the MIT License.",
    ]
    assert scan(spark, texts) == {0: (None, ["MIT"]), 1: (None, ["Apache-2.0", "CC-BY-NC-4.0"]), 2: (None, []), 3: ("MIT", ["MIT"])}


def test_other_known_texts(spark):
    known = spark.createDataFrame([("Mine", "text", "Do what you like."), ("None", "text", " ?! ")], L.KNOWN_SCHEMA)
    assert scan(spark, ["do what, you LIKE", TEXT["MIT"], "!"], known) == {0: ("Mine", []), 1: (None, []), 2: (None, [])}


def test_awkward_rows(spark, awkward, nothing):
    rows = L.scan_licenses(awkward).collect()
    assert len(rows) == awkward.count() and all(r.license_id is None and r.notices == [] for r in rows)
    assert L.scan_licenses(nothing).count() == 0


FILES = {f.stem: f.read_text(encoding="utf-8") for f in sorted(L.TEXT_FILES.glob("*.txt"))}


def _wrapped(text, width):
    """Paragraphs wrapped anew; those that hold a copyright statement, which is a line of its own, stay."""
    parts = re.split(r"(\n\s*\n)", text)
    fill = lambda p: p if "copyright" in p.lower() or not p.strip() else "\n".join(textwrap.wrap(p, width, break_on_hyphens=False, break_long_words=False))
    return "".join(map(fill, parts))


def test_texts_of_the_files(spark):
    assert len(FILES) == 13
    texts, want = [], []
    for i, text in FILES.items():
        for t in (text, text.upper(), *(_wrapped(text, w) for w in (50, 72, 100))):
            texts += [t, "Copyright (C) 2001 A. Person\n\n" + t, t.replace("license", "licence"), t.rsplit(".", 1)[0] + " or not."]
            want += [i, i, i, None]
    got = scan(spark, texts)
    assert [got[n][0] for n in range(len(texts))] == want


def test_twin_is_the_same_function(spark, tmp_path):
    texts = [None, "", "Copyright holders of the work\nand others", "copyright\n * holder", "x per\ncent y fulfil\n# z", "all rights reserved\nx", "\tcopyright 2001 and\ny"]
    fills = ["\n".join(textwrap.wrap(t, w, break_on_hyphens=False, break_long_words=False)) for t in TEXT.values() for w in (20, 47, 80)]
    texts += [t for fill in fills for t in ("Copyright 2020 X\n" + fill, " * " + fill.replace("\n", "\n * "))]
    texts += list(FILES.values()) + ["Released under the MIT License.\nSPDX-License-Identifier: GPL-3.0"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, digest, license_id, notices FROM ({SQL_LICENSES})").fetchall()}
    got = {r.doc_id: (r.digest, r.license_id, r.notices) for r in q_licenses(spark, str(tmp_path)).collect()}
    assert got == want and sum(r[1] is not None for r in got.values()) >= len(FILES) + 2 * 3 * len(TEXT)
