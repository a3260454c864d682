"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text is canonicalised (case, copyright lines, equivalent spellings, then
punctuation and white space), its SHA-256 is taken, and digests are
hash-joined with those of known licence texts, canonicalised by the same
functions. Two units are looked up, always whole: the entire document, and
each of its lines (licence notices stand on a line of their own). A line is
hashed only if a known notice has its canonical length, which no match can lack.

The longer licences are files of ``license_texts``, named by their SPDX ids: public texts as their stewards publish them.

Defined results: null text counts as empty and matches nothing, as does a
text or line without letters or digits; a line that repeats counts once;
repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtable.llm.common import join_hot, row_key, stage

TEXT_FILES = Path(__file__).parent / "license_texts"

# Words that count as the same, after lower-casing (first form -> second form).
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
    ("acknowledgement", "acknowledgment"),
    ("authorisation", "authorization"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("analogue", "analog"),
    ("whilst", "while"),
    ("http://", "https://"),
    ("&", " and "),
)

# The spellings of two words where a line ends between them, as (pattern, replacement).
_LINE_END = r"([ \t]*\n[\s*#/;<!-]*)"
WRAPPED_SPELLINGS = (
    (rf"copyright{_LINE_END}holder", "copyright$1owner"),
    (rf"\bper{_LINE_END}cent\b", "percent$1"),
    (rf"\bfulfil{_LINE_END}", "fulfill$1"),
)

#: Words after "copyright" with which a sentence of a licence goes on, also on the next line: no copyright statement.
_GOES_ON = "holders?|owners?|notices?|interests?|laws?|licen[cs]es?|permissions?|statements?|disclaimers?|protection|treaty|acts?|and|or|in|is|of|to"
# Patterns of canonicalisation. A "copyright" that a sentence goes on from is spelt HELD while statements are
# taken out, so that no pattern needs to look ahead and all of them mean the same in other engines.
HELD = "\x01held\x01"
COPYRIGHT_SENTENCE = (r"copyright\b([\s*#/;<!-]*)(" + _GOES_ON + r")\b", HELD + "$1$2")
COPYRIGHT_STATEMENT = (r"(^|\n)[ \t*#/;<!-]*(copyright\b|\(c\)[ \t]*(copyright|[0-9])|©|all rights reserved)[^\n]*", "$1")
NOT_WORD = r"[^\p{L}\p{N}\n]+"

# Known licences, (SPDX id, title, text without title and copyright line).
_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
_BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""
TEXTS = (
    (
        "MIT",
        "MIT License",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""
        + _DISCLAIMER,
    ),
    (
        "ISC",
        "ISC License",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.
"""
        + _ISC_DISCLAIMER,
    ),
    (
        "0BSD",
        "BSD Zero Clause License",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.
"""
        + _ISC_DISCLAIMER,
    ),
    ("BSD-2-Clause", "BSD 2-Clause License", "\n".join((_BSD_TERMS, _BSD_DISCLAIMER))),
    ("BSD-3-Clause", "BSD 3-Clause License", "\n".join((_BSD_TERMS, _BSD_NAME, _BSD_DISCLAIMER))),
    (
        "Zlib",
        "zlib License",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use
this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    (
        "Unlicense",
        "The Unlicense",
        """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest
in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of
our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and
future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN
CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
For more information, please refer to <https://unlicense.org>""",
    ),
)

# Names that notices use, by SPDX id, and the sentences they stand in.
NAMES = (
    ("MIT", ("MIT License", "MIT")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPLv3")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPLv3")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "New BSD License", "Modified BSD License")),
    ("ISC", ("ISC License",)),
    ("Unlicense", ("Unlicense",)),
    ("CC0-1.0", ("CC0 1.0", "CC0 1.0 Universal")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0",)),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0",)),
)
SUBJECTS = ("", "This work is ", "This project is ", "This software is ", "This file is ", "This document is ")
VERBS = ("licensed under ", "released under ", "distributed under ", "available under ")
ARTICLES = ("", "the ", "a ", "the terms of the ")

KNOWN_SCHEMA = "license_id string, unit string, text string"


def known_licenses() -> list[tuple[str, str, str]]:
    """(license_id, unit, text): unit ``text`` is looked up for documents, ``notice`` for lines and documents."""
    rows = [(i, "text", t) for i, title, body in TEXTS for t in (body, f"{title}\n{body}", f"The {title}\n{body}")]
    rows += [(f.stem, "text", f.read_text(encoding="utf-8")) for f in sorted(TEXT_FILES.glob("*.txt"))]
    for i, names in NAMES:
        rows.append((i, "notice", f"SPDX-License-Identifier: {i}"))
        rows += [(i, "notice", f"{s}{v}{a}{n}") for n in names for s in SUBJECTS for v in VERBS for a in ARTICLES]
    return rows


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text's lines that have letters or digits."""
    out = F.regexp_replace(F.lower(text), *COPYRIGHT_SENTENCE)
    out = F.replace(F.regexp_replace(out, *COPYRIGHT_STATEMENT), F.lit(HELD), F.lit("copyright"))
    out = reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), SPELLINGS, out)
    out = reduce(lambda t, s: F.regexp_replace(t, *s), WRAPPED_SPELLINGS, out)
    out = F.regexp_replace(out, NOT_WORD, " ")
    lines = F.transform(F.split(out, "\n"), lambda x: F.trim(x))
    return F.filter(lines, lambda x: x != "")


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def known_digests(spark: SparkSession, known: DataFrame | None = None) -> DataFrame:
    """``digest, unit, license_id, length``; of several licences with one canonical text the first id stays."""
    known = spark.createDataFrame(known_licenses(), KNOWN_SCHEMA) if known is None else known
    lines = canonical_lines(F.coalesce("text", F.lit("")))
    rows = known.select("license_id", "unit", F.concat_ws(" ", lines).alias("canonical")).where("canonical <> ''")
    keys = (_digest(F.col("canonical")).alias("digest"), F.length("canonical").alias("length"), "unit")
    return rows.groupBy(*keys).agg(F.min("license_id").alias("license_id"))


def scan_licenses(
    docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``<id_col>, digest, license_id, notices, row_key``.

    ``digest``: of the entire canonical text; ``license_id``: the known licence it is, or null;
    ``notices``: ids of licences named by a notice that is a whole line, in order.
    """
    digests = stage(known_digests(docs.sparkSession, known), "license-known")
    lengths = [r["length"] for r in digests.where("unit = 'notice'").select("length").distinct().collect()]  # lengths of known notices
    lines = canonical_lines(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("id"), row_key(docs, id_col, text_col).alias("key"), lines.alias("lines"))
    rows = rows.select(
        "id",
        "key",
        _digest(F.concat_ws(" ", "lines")).alias("digest"),
        F.transform(F.array_distinct(F.filter("lines", lambda x: F.length(x).isin(lengths))), _digest).alias("line_digests"),
    )
    rows = stage(rows, "license-digests")

    notices = digests.where("unit = 'notice'").select("digest", "license_id")
    each = rows.select("key", F.explode("line_digests").alias("digest")).join(notices, "digest")
    named = each.groupBy("key").agg(F.array_sort(F.collect_set("license_id")).alias("notices"))  # bounded by the known ids
    # a document that is nothing but a known text or notice
    whole = digests.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    out = join_hot(join_hot(rows.drop("line_digests"), whole, "digest", "left"), named, "key", "left")
    none = F.expr("cast(array() as array<string>)")
    return out.select(F.col("id").alias(id_col), "digest", "license_id", F.coalesce("notices", none).alias("notices"), F.col("key").alias("row_key"))
