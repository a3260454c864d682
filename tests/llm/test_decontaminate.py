"""Decontamination against a slow search for shared word runs, and hand-made re-parameterised questions."""

import numpy as np
import pytest
from cases import SF_ORACLE, awkward, nothing  # noqa: F401
from pyspark.sql import functions as F

from recordtable.llm import decontaminate as D
from recordtable.llm.queries import QUERIES

ITEM = "Ann has 3 apples and gives 2 of them to Bob who then eats 3 apples at home with Ann before 5 km of walking."


def leaks(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    return {(r.doc_id, r.item_id): r.changed for r in D.find_leaks(docs, bench).collect()}


def test_windows_hash_content_and_size_only():
    h = np.random.default_rng(0).integers(0, 1 << 63, 60, dtype=np.uint64)
    for size in range(1, 14):
        w, moved = D.windows(h, size), D.windows(h[20:], size)
        assert len(w) == 60 - size + 1 and len(set(w.tolist())) == len(w)
        assert (w[20:] == moved).all()
    assert not len(D.windows(h[:3], 4))


def test_template():
    words = D._Words()
    _, literal, place = D.template("In Rome, Ann ran 5 km. Then ... she ate 2.5 cups".split(), words)
    # names, numbers and units are slots; a bare "..." is left out; a sentence's first word is a word
    assert [bool(x) for x in literal] == [True, False, False, True, False, False, True, True, True, False, False]
    assert len(place) == 11
    one, _, _ = D.template("She paid 30 dollars to Joe".split(), words)
    two, _, _ = D.template("she paid 7 euros to Eve!".split(), words)
    assert one.tolist() == two.tolist()


def test_copies_changed_copies_and_others(spark):
    texts = [
        ITEM,
        f"Some words before. {ITEM} And words after it.",
        ITEM.replace("Ann", "Eve").replace("Bob", "Tom").replace("3", "7").replace("2 of", "4 of"),
        ITEM.replace("eats 3", "eats 9"),  # 3 stands for two values
        ITEM.replace("Bob", "Ann"),  # two names for one
        "Ann has apples. They are red and she likes to eat them in the garden with Bob in the evening.",
        ITEM.upper(),
        None,
        "",
    ]
    got = leaks(spark, texts, [ITEM, None, ""])
    # windows beside one changed value, or a name that stands for two, are verbatim; in capitals the stretch before the first name is
    assert got == {(0, 0): False, (1, 0): False, (2, 0): True, (3, 0): True, (4, 0): True, (6, 0): False}


def test_short_items_and_placeholders_only(spark):
    items = ["only five words are here", "1 2 3 4 5 6 7 8 9 10 11 12", "three words only"]
    texts = ["and only five words are here again", "9 8 7 6 5 4 3 2 1 10 11 12 13", "these three words only", "only five words are not here"]
    assert leaks(spark, texts, items) == {(0, 0): False}
    # items below SHORT_ITEM tokens match whole documents only
    items, texts = ["Yes", "three words only"], ["Yes , he said", "yes!", "Oh yes", "Three words only.", "three words only here", "Yes yes"]
    assert leaks(spark, texts, items) == {(1, 0): False, (3, 1): False}


def test_part_of_an_item(spark):
    item = " ".join(f"w{c}ord" for c in "abcdefghijklmnopqrstuvwxyz")
    words = item.split()
    texts = [" ".join(words[5:15]), " ".join(words[5:14]), "x " + " ".join(words[-10:]) + " y", " ".join(words[::2])]
    assert set(leaks(spark, texts, [item])) == {(0, 0), (2, 0)}


def test_tables_of_pairs_say_no_only_where_no_window_matches(spark):
    docs, bench = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [r.text for r in docs.select("text").limit(150).collect()] + [r.text for r in bench.collect()]

    def found(pair_bits):
        import pyarrow as pa

        rows = pa.record_batch({"__row": pa.array(range(len(texts))), "__text": pa.array(texts)})
        out = next(D._windows(iter([rows]), D.WINDOW, D.MIN_LITERALS, [4, 6], bits, pair_bits)).to_pylist()
        return {(r["row"], r["size"], r["h"], r["pos"], tuple(r["slots"])) for r in out}

    items = D._window_rows(bench, F.col("item_id"), "text", D.WINDOW, D.MIN_LITERALS, None, None, None)
    bits = D._bit_table(items.select(F.shiftrightunsigned("h", 64 - D.TABLE_BITS).alias("s")))
    pair_bits = D._bit_table(bench.select(F.col("text").alias("__text")).mapInArrow(D._known_pairs, "s long"))
    known = {(r["size"], r["h"]) for r in items.select("size", "h").collect()}
    everything = {x for x in found(None) if x[1:3] in known}
    assert everything and everything == {x for x in found(pair_bits) if x[1:3] in known}


def test_table(spark):
    docs, bench = (spark.read.parquet(f"{SF_ORACLE}/{t}.parquet") for t in ("documents", "benchmark"))

    def words(text):
        return [w.strip(D.OUTER).lower() for w in (text or "").split() if w.strip(D.OUTER)]

    where = {}
    for item in bench.collect():
        w = words(item.text)
        for i in range(len(w) - D.WINDOW + 1):
            where.setdefault(tuple(w[i : i + D.WINDOW]), set()).add(item.item_id)
    want = set()
    for d in docs.collect():
        w = words(d.text)
        for i in range(len(w) - D.WINDOW + 1):
            want |= {(d.doc_id, item) for item in where.get(tuple(w[i : i + D.WINDOW]), ())}
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()}
    assert got == want and want


def test_awkward_rows(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog. The second line of the text")], "item_id int, text string")
    left = D.drop_leaks(awkward, bench)
    assert left.columns == awkward.columns
    assert left.count() == awkward.count() - 1
    assert left.where("doc_id = 1").count() == 0
    assert D.drop_leaks(awkward, bench.limit(0)).count() == awkward.count()
    assert D.find_leaks(nothing, bench).count() == 0


@pytest.mark.parametrize("copies", [40])
def test_repeats_within_a_document(spark, copies):
    assert leaks(spark, [" ".join([ITEM] * copies)], [ITEM]) == {(0, 0): False}


def leaks_of_query(spark, tmp_path, texts, items):
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return {(r.doc_id, r.item_id): r.changed for r in QUERIES["op6_decontamination"](spark, str(tmp_path)).collect()}


def test_query_counts_verbatim_windows_beside_a_changed_value(spark, tmp_path):
    item = "they sold 3 apples and 4 pears to some people who came by with 20 friends in the evening"
    texts = [
        ITEM.replace("eats 3", "eats 9"),
        ITEM.replace("Bob", "Ann"),
        item.replace("3", "5").replace("4", "5"),  # two values become one
        "they sold 3 apples and 3 pears to some people who",
        "they gave 3 apples and 4 pears to all people who came",
    ]
    assert leaks_of_query(spark, tmp_path, texts, [ITEM, item]) == dict.fromkeys([(0, 0), (1, 0), (2, 1), (3, 1)], True)
    same_value = [item.replace("4", "3")]
    assert leaks_of_query(spark, tmp_path / "one", ["they sold 5 apples and 6 pears to some people who"], same_value) == {}


def test_readings_are_windows_of_the_changed_tokens():
    words = D._Words()
    hashed, literal, _, maybe, _ = D._template("Ann ran. Bob ate. Then: Eve saw Tom go home".split(), words, [])
    assert [int(i) for i in np.nonzero(maybe)[0]] == [0, 2, 4, 5]
    tokens, lines = D._lines("so Ann\n - Bob saw\n\n Eve")
    assert D._template(tokens, words, lines)[3].tolist() == [False, False, True, False, True]
    for size in (3, 6, 10):
        got = {(int(p), int(b)): int(x) for at, h, names in D._readings(hashed, literal, maybe, size, 1) for p, x, b in zip(at, h, names, strict=True)}
        want = {}
        for p in range(len(hashed) - size + 1):
            for bits in range(1 << size):
                read = [o for o in range(size) if bits >> o & 1]
                if all(maybe[p + o] for o in read) and literal[p : p + size].sum() - len(read) >= 1:
                    changed = hashed.copy()
                    changed[[p + o for o in read]] = D._PLACEHOLDER[3]
                    want[p, bits] = int(D.windows(changed, size)[p])
        assert got == want


def test_names_that_start_sentences(spark, tmp_path):
    item = "Ann has 3 apples. Ann buys 4 pears at the market. Bob takes 2 apples from Ann. The rest is left."
    short = "Where do the birds of the north go"
    named = "Rome is where the emperors lived"
    texts = [
        item.replace("Ann", "Eve").replace("Bob", "Tom"),
        "Question: " + item.replace("Ann", "Eve").replace("Bob", "Tom").replace("The rest", "the rest"),
        f"Question: {short}? Answer",
        f"# A Heading\n{short}",
        f"and we ask {short} in winter",
        f"Places\n{named.replace('Rome', 'Paris')}\n",
        f"as said {named}",
        "rome was where the emperors lived",
    ]
    assert leaks_of_query(spark, tmp_path, texts, [item, short, named]) == {
        (0, 0): True, (1, 0): True, (2, 1): False, (3, 1): False, (4, 1): False, (5, 2): True, (6, 2): False
    }


def test_verbatim_windows_of_few_words(spark, tmp_path):
    items = ["What is 12 + 15 ?", "Solve 3x + 4 = 10", "1 2 3 4 5 6 7 8 9 10 11 12", "Ann met Bob Eve Tom Joe Max Ida Leo Kim Una Zoe"]
    texts = [
        "Question: what is 12 + 15? Answer: 27",
        "now solve 3x + 4 = 10 for x",
        "rows\n2 3 4 5 6 7 8 9 10 11\n",
        "and Bob Eve Tom Joe Max Ida Leo Kim Una Zoe went",
        "What is 12 + 16 ? Solve 3x + 4 = 11",
        "2 3 4 5 6 7 8 9 10 12",
        "and Bob Eve Tom Joe Max Ida Leo Kim Una Pat went",
    ]
    assert leaks_of_query(spark, tmp_path, texts, items) == {(0, 0): False, (1, 1): False, (2, 2): False, (3, 3): False}
