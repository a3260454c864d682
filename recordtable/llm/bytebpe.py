"""Byte-level BPE in tasks: the ids of the ``tokenizers`` library for a ``tokenizer.json``, in linear time for any text.

A text is cut at special tokens, then into pre-tokens by the published split
pattern, written with explicit character classes so that Python's ``re`` runs
it; each pre-token is merged by itself. The classes are those of Python's
Unicode tables. A character they do not know may be a letter to the library:
a text that holds one is left to the library itself.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain

import tiktoken
from tokenizers import Tokenizer

# The published byte-level BPE split pattern, and the characters that it takes as white space.
BYTE_BPE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

#: Pre-tokens of longer texts are found one after the other, not as one list.
LONG_TEXT = 1 << 20
#: Merged pre-tokens that a task remembers, and the longest of them; more costs time only.
REMEMBERED, LONGEST = 1 << 18, 64


class UnknownCharacter(ValueError):
    """The text holds a character that Python's Unicode tables do not know."""


def _pattern(letter: str, number: str, space: str, unknown: str) -> re.Pattern[str]:
    other = f"{space}{letter}{number}{unknown}"
    last = f"|[{unknown}]" if unknown else ""
    return re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^{other}]+|[{space}]+(?![^{space}])|[{space}]+{last}")


@cache
def _patterns() -> tuple[re.Pattern[str], re.Pattern[str]]:
    """(for ASCII texts, for all texts); the second gives unknown characters as pre-tokens of their own."""
    classes: dict[str, list[str]] = {"L": [], "N": [], "Cn": []}
    first, before = 0, ""
    for code in range(0x110001):
        kind = unicodedata.category(chr(code)) if code < 0x110000 else ""
        kind = kind if kind == "Cn" else kind[:1]
        if kind != before:
            if before in classes:
                classes[before].append(f"{re.escape(chr(first))}-{re.escape(chr(code - 1))}")
            first, before = code, kind
    return _pattern("A-Za-z", "0-9", "\t-\r ", ""), _pattern(*("".join(classes[k]) for k in ("L", "N")), SPACES, "".join(classes["Cn"]))


def pretokens(text: str) -> Iterable[str]:
    """The pre-tokens of a text without special tokens."""
    pattern = _patterns()[0 if text.isascii() else 1]
    if len(text) <= LONG_TEXT:
        return pattern.findall(text)
    return (m[0] for m in pattern.finditer(text))


def load(vocabulary: str) -> tuple[tiktoken.Encoding, dict[str, int]]:
    """(merges of a byte-level ``tokenizer.json`` whose ids follow the order of its merges, special tokens)."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    # bytes are written as printable characters: these stand for themselves, the others follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    as_char = {chr(b): b for b in plain}
    as_char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(as_char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("byte_bpe", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=ranks, special_tokens=special), special


def byte_bpe(vocabulary: str) -> tiktoken.Encoding:
    """Encoder that gives the ids of the ``tokenizers`` library but fails on very long runs of white space."""
    return load(vocabulary)[0]


class Pieces(dict):
    """Pre-token -> what ``made`` makes of its ids; ``known`` entries stay, merged ones are remembered within bounds."""

    def __init__(self, encoding: tiktoken.Encoding, made: Callable[[list[int]], object], known: dict[str, object]):
        super().__init__(known)
        self.encoding, self.made, self.known = encoding, made, known

    def __missing__(self, piece: str) -> object:
        if len(piece) == 1 and unicodedata.category(piece) == "Cn":
            raise UnknownCharacter(piece)
        value = self.made(self.encoding._encode_single_piece(piece))
        if len(piece) <= LONGEST:
            if len(self) - len(self.known) >= REMEMBERED:
                self.clear()
                self.update(self.known)
            self[piece] = value
        return value


class Encoder:
    """Ids and numbers of ids of whole texts. ``whole``: pre-tokens known to be one token (see :func:`whole_tokens`)."""

    def __init__(self, vocabulary: str, whole: Iterable[str] = ()):
        self.vocabulary = vocabulary
        self.encoding, self.special = load(vocabulary)
        names = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.ids = Pieces(self.encoding, tuple, {})
        self.sizes = Pieces(self.encoding, len, dict.fromkeys(whole, 1))
        self.library: Tokenizer | None = None

    def _parts(self, text: str) -> Iterator[tuple[int | None, str]]:
        """(id, text) of special tokens, (None, text) of what stands between."""
        for part in self.cut.split(text) if self.cut else [text]:
            yield self.special.get(part), part

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            self.library = Tokenizer.from_file(self.vocabulary)
            self.library.no_truncation()
            self.library.no_padding()
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        try:
            for special, part in self._parts(text):
                if special is not None:
                    out.append(special)
                else:
                    out += chain.from_iterable(map(self.ids.__getitem__, pretokens(part)))
        except UnknownCharacter:
            return self._by_library(text)
        return out

    def ids_of(self, text: str) -> list[int]:
        """As :meth:`encode`, by the faster splitter, which fails on very long runs of white space."""
        try:
            return self.encoding.encode(text, allowed_special="all")
        except ValueError:
            return self.encode(text)

    def count(self, text: str) -> int:
        try:
            return sum(1 if special is not None else sum(map(self.sizes.__getitem__, pretokens(part))) for special, part in self._parts(text))
        except UnknownCharacter:
            return len(self._by_library(text))


@cache
def encoder(vocabulary: str) -> Encoder:
    """One encoder per vocabulary and Python process."""
    return Encoder(vocabulary)


def whole_tokens(vocabulary: str) -> list[str]:
    """Strings of the vocabulary whose own merges end in that one token, in order of their ids.

    Not all do: the merges that lead to a string may be taken in another order
    when it stands alone. Entries that are no whole UTF-8 text are never a pre-token.
    """
    encoding, _ = load(vocabulary)
    proved = []
    for token, number in encoding._mergeable_ranks.items():
        if encoding._encode_single_piece(token) == [number]:
            try:
                proved.append(token.decode())
            except UnicodeDecodeError:
                continue
    return proved
