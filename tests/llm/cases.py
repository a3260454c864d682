"""Shared cases of these tests; the fixtures are imported where they are used."""

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# a table with every awkward case; the columns after source have names that operators use for results
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, row_key long, id string, key string, "
    "score double, component_id long, digest string, length long, h long, g long, number long, label string"
)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nThe second line of the text stands here.", "en", "a"),
    (2, "Ein anderer Text steht hier auf Deutsch für die Prüfung.", "de", "a"),
    (3, "Ein anderer Text steht hier auf Deutsch für die Prüfung.", "de", None),
    (3, "Ein anderer Text steht hier auf Deutsch für die Prüfung.", "de", None),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \n\t ", None, "b"),
    (7, "12345 !!! 678", "en", "b"),
    (8, "Émoji 😀 et accents éèç, encore une fois.", "fr", "c"),
    (None, "A row without an id.", "en", "c"),
    (9, "one", "xx", "c"),
    (10, LONG, "en", "d"),
    (11, LONG, None, "d"),
    (11, "another text under the same id", "en", "d"),
]
CLASH = (True, 7, "x", "y", 0.5, 3, "z", 4, 5, 6, 7, "w")


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame([(i, t, lang, s, 1, *CLASH) for i, t, lang, s in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
