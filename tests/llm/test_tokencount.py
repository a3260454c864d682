"""Token counts against the tokenizers library, and the proof of whole tokens against it."""

import random

import public_tokenizers
import pytest
from cases import SF_SMALL, awkward, nothing  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recordtable.llm import bytebpe
from recordtable.llm.queries import QUERIES
from recordtable.llm.tokencount import count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
WHOLE = bytebpe.whole_tokens(PATH)
ENCODER = bytebpe.Encoder(PATH, WHOLE)


def slow(text):
    return len(TOKENIZER.encode(text or "", add_special_tokens=False).ids)


@settings(deadline=None, max_examples=400)
@given(st.text(max_size=80) | st.text(alphabet=st.sampled_from("ab1 2.é\n\t\x1c\x85\xa0'sß世²Ⅷ½_  <|endoftext>"), max_size=80))
def test_counts_are_those_of_the_tokenizers_library(text):
    assert ENCODER.count(text) == slow(text) == len(ENCODER.encode(text))


def test_unknown_characters_are_left_to_the_library():
    # unassigned in Python's tables, between letters, digits and signs
    for c in ("\u0378", "\u209d", "\U000323b0", "\uffff"):
        for text in (f"a{c}b 1{c}2 !{c}?", c * 5, f" {c}"):
            assert ENCODER.count(text) == slow(text)


def test_whole_tokens_are_proved():
    assert len(WHOLE) == len(set(WHOLE)) > 45_000
    for token in random.Random(1).sample(WHOLE, 3000):
        if len(list(bytebpe.pretokens(token))) == 1 and "<|" not in token:
            assert slow(token) == 1
    # strings of the vocabulary that are not proved are not counted as one without merging
    assert ENCODER.sizes.keys() >= set(WHOLE)


def test_special_tokens_and_long_words():
    for text in ("<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext", "x" * 300_000, " " * 300_000 + "<|endoftext|>" + " " * 9):
        assert ENCODER.count(text) == slow(text)


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(bytebpe, "REMEMBERED", 10)
    small = bytebpe.Encoder(PATH, WHOLE)
    text = " ".join(f"zqx{i}vv" for i in range(200))
    assert small.count(text) == slow(text)
    assert len(small.sizes) <= len(WHOLE) + 10


def test_long_texts_are_not_listed(monkeypatch):
    monkeypatch.setattr(bytebpe, "LONG_TEXT", 50)
    text = "Some words, more words and 12 numbers é. " * 20
    assert not isinstance(bytebpe.pretokens(text), list)
    assert ENCODER.count(text) == slow(text)


def test_awkward(spark, awkward):
    got = sorted((tuple(r) for r in count_tokens(awkward, PATH, limit=10).collect()), key=str)
    want = [(r.doc_id, len((r.text or "").encode()), slow(r.text), slow(r.text) > 10) for r in awkward.collect()]
    assert got == sorted(want, key=str)


def test_nothing(nothing):
    assert count_tokens(nothing, PATH).columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert count_tokens(nothing, PATH).count() == 0


@pytest.mark.parametrize("folder", [SF_SMALL])
def test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = {(r.doc_id, len((r.text or "").encode()), slow(r.text), slow(r.text) > 512) for r in docs}
    assert {tuple(r) for r in QUERIES["op11_token_counts"](spark, folder).collect()} == want
