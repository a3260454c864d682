"""Text compared as a database collation does, in place of ``lower()`` on both sides.

``UTF8_LCASE`` ignores case by code point, ``UNICODE_CI`` by the rules of Unicode,
``UNICODE_CI_AI`` case and accents (``é`` = ``E``, ``ß`` = ``ss``), and a language's collation
(``tr_CI``: ``İ`` = ``i``) its own rules. A collated column is compared, grouped and hashed by
Spark itself; the stored text stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collated(c: Column | str, collation: str | None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c if collation is None else F.collate(c, collation)


def plain(c: Column | str) -> Column:
    """The text compared by its bytes again."""
    return F.collate(F.col(c) if isinstance(c, str) else c, "UTF8_BINARY")


def contains_pattern(c: Column, text: str, mode: str, collation: str) -> Column:
    """Whether ``c`` contains ``text`` under ``collation``: ``find``'s rules for ``mode``.

    Spark's LIKE compares by code points, so it serves ``UTF8_LCASE`` alone. Under the other
    collations the parts between ``%`` are looked for one after another, each at
    its first place behind the part before; a match may be longer or shorter
    than its part (``ss`` in ``Straße``). ``_`` has no meaning there and is refused.
    """
    text_col = collated(c, collation)
    if mode == "literal":
        return text_col.contains(F.lit(text))
    if mode != "like":
        raise ValueError(f"unknown find mode {mode!r}")
    if collation.upper() in ("UTF8_LCASE", "UTF8_BINARY"):
        return text_col.like("%" + text.replace("\\", "\\\\") + "%")
    if "_" in text:
        raise ValueError(f"the wildcard _ stands for one code point and has no match under {collation}")
    parts = [p for p in text.split("%") if p]
    if len(parts) < 2:
        return text_col.contains(F.lit(parts[0] if parts else ""))
    rest, found = text_col, F.lit(True)
    for part in parts[:-1]:
        found = found & rest.contains(F.lit(part))
        rest = _behind(rest, part, collation)
    return found & rest.contains(F.lit(parts[-1]))


def _behind(rest: Column, part: str, collation: str) -> Column:
    """What follows the first match of ``part``, whose length is the least for which the two are equal."""

    def cut(t: Column) -> Column:
        at = F.locate(part, t)
        ends = F.sequence(at, F.greatest(at, F.length(t)))
        ends = F.filter(ends, lambda e: collated(F.substring(t, at, e - at + 1), collation) == collated(F.lit(part), collation))
        end = F.get(ends, F.lit(0))
        return F.when((at > 0) & end.isNotNull(), F.substring(t, end + 1, F.length(t)))

    # the rest is worked out once, however often it is used
    return collated(F.get(F.transform(F.array(rest), cut), F.lit(0)), collation)
