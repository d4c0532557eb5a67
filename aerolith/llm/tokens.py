"""Token ids of whole texts by a public byte-level vocabulary, fast for repeated words.

The vocabulary's splitting rule never lets a token cross a space that stands before a
character other than white space, nor a single line end between two such characters.  These
are therefore exact cut points: the words between them are encoded by the tokenizers library
once per worker and looked up after.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

from aerolith.llm.common import SLICE_CHARS

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: White space in any Unicode version; a space before one of these is no cut point.
_BLANK = "\\s\u180e"
_BLANK_FIRST = re.compile(f"[{_BLANK}]")
_CUT = re.compile(f" (?=[^{_BLANK}])")
#: Latin letters and marks but apostrophes behind them, after a line end perhaps: the splitting rule cuts exactly
#: between these groups.
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_MOST_MARKS = 10_000


def byte_letters() -> dict[int, str]:
    """Byte -> character that stands for it in byte-level vocabularies: itself if visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {**{b: chr(b) for b in visible}, **{b: chr(256 + n) for n, b in enumerate(hidden)}}


class _Irregular(Exception):
    """A word is empty or starts with white space: splitting at every space isn't enough."""


class _Words(dict):
    """Word -> ids of the word with a space before it, or without one if it begins with a line end; encodes unknown words.

    Keeps at most ``most`` words of at most ``longest`` characters.  When it is full nothing
    more is kept: common words come early.
    """

    def __init__(self, tokenizer: Tokenizer, most: int, longest: int):
        super().__init__()
        self.tokenizer, self.most, self.longest = tokenizer, most, longest
        self.model, self.letters = tokenizer.model, byte_letters()
        self.line = ids_of(tokenizer, "\n")
        self.marks = {"": b""}

    def _marks(self, marks: str) -> bytes:
        ids = self.marks.get(marks)
        if ids is None:
            ids = ids_of(self.tokenizer, marks)
            if len(self.marks) < _MOST_MARKS:
                self.marks[marks] = ids
        return ids

    def __missing__(self, word: str) -> bytes:
        if plain := _PLAIN.fullmatch(word):  # already split: straight to the library's merges
            line, letters, marks = plain.groups()
            if letters.isascii():  # these letters stand for themselves
                name = letters if line else f"{self.letters[32]}{letters}"
            else:
                name = "".join(map(self.letters.__getitem__, (letters if line else f" {letters}").encode()))
            found = [token.id for token in self.model.tokenize(name)]
            ids = (self.line if line else b"") + struct.pack(f"<{len(found)}I", *found) + self._marks(marks)
        else:
            inner = word[1:] if word[:1] == "\n" else word
            if not inner or _BLANK_FIRST.match(inner):
                raise _Irregular
            ids = ids_of(self.tokenizer, word if word[0] == "\n" else f" {word}")
        if len(self) < self.most and len(word) <= self.longest:
            self[word] = ids
        return ids


def ids_of(tokenizer: Tokenizer, text: str) -> bytes:
    """Little-endian unsigned 32-bit ids of ``text``, by the library alone."""
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, most_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.words = _Words(self.tokenizer, most_words, longest=48)

    def _slice(self, text: str, led: bool) -> bytes:
        """``led``: a space that isn't in ``text`` stands before it."""
        try:
            return self._parts(text.replace("\n", " \n").split(" "), led)
        except _Irregular:
            return self._parts(_CUT.split(text), led)

    def _parts(self, parts: list[str], led: bool) -> bytes:
        if led:
            return b"".join(map(self.words.__getitem__, parts))
        first, *rest = parts
        return (ids_of(self.tokenizer, first) if first else b"") + b"".join(map(self.words.__getitem__, rest))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) <= SLICE_CHARS:
            return self._slice(text, led=False)
        out, at, led = [], 0, False
        while at < len(text):
            found = _CUT.search(text, at + SLICE_CHARS)
            cut = found.start() if found else len(text)
            out.append(self._slice(text[at:cut], led))
            at, led = cut + 1, True
        return b"".join(out)


@lru_cache(maxsize=2)
def encoder(path: str, most_words: int = 600_000) -> WordEncoder:
    """One encoder per Python worker and vocabulary; fewer remembered words take less memory and more time."""
    return WordEncoder(path, most_words)
