"""BPE encoding by backtracking over longest matches, decoding by an offset table.

A sequence of tokens is what the merges would give exactly if every two neighbours are
compatible, that is, if merging their joint text would leave the border between them.  So no
merge is ever carried out: an Aho-Corasick automaton finds the longest token at each place of
a word, the encoder takes it, or the next shorter one that is compatible with the token
before, and steps back where none is left.  A place that was left once is never entered again,
because the text before it has only one encoding; hence the time is linear in the word.

Normalising and splitting are those of the vocabulary file.  White space ends a word under
its rules, therefore the chunks between blanks, line ends and tabs are encoded one by one, and
short ones are remembered by each worker.  Chunks of common letters are lowered and split
here; any other chunk is normalised and split by the library's own components.

Null and empty texts have no ids and decode to an empty text.  Strings of added tokens inside
a text become their ids, as the library does it.  Ids and rows may repeat; other columns are
not read; an empty table gives an empty table.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aerolith.llm.common import slices
from aerolith.llm.tokens import byte_letters

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

#: Stands for the end of a word inside this module; no byte letter is this character.
_END = "\0"
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Chunks of these characters are normalised by lowering alone, whatever the version of Unicode.
_COMMON = re.compile(f"[!-~{_LATIN}]*")
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LATIN}]+|[0-9]|[^0-9{_LATIN}]+")
#: Normalisation and splitting that this module knows; another file needs another module.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MOST_PAIRS = 2_000_000


class Backtracking:
    """The merges of a vocabulary as an automaton, a table of shorter prefixes and one of compatible pairs."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        def own(piece: str) -> str:
            return piece[: -len(suffix)] + _END if suffix and piece.endswith(suffix) else piece

        ids = {own(piece): i for piece, i in vocabulary.items()}
        self.end = _END if suffix else ""
        size = max(ids.values()) + 1
        self.rank = [-1] * size  # when a token comes into being; single symbols are there from the start
        self.left, self.right = list(range(size)), list(range(size))
        self.merged: dict[tuple[int, int], int] = {}
        whole = {own(a) + own(b) for a, b in merges}
        for rank, (a, b) in enumerate((own(a), own(b)) for a, b in merges):
            made = ids[a + b]
            if self.rank[made] >= 0 or any(part in whole and self.rank[ids[part]] < 0 for part in (a, b)):
                raise ValueError("a token has two merges, or a merge uses later tokens")
            self.rank[made], self.left[made], self.right[made] = rank, ids[a], ids[b]
            self.merged[ids[a], ids[b]] = rank
        self.never = len(merges)
        self.pairs: dict[tuple[int, int], bool] = {}
        # A token that its own merges wouldn't build, or whose parts aren't built, is part of no encoding.
        good = [rank < 0 for rank in self.rank]
        for i in sorted((i for i in ids.values() if self.rank[i] >= 0), key=self.rank.__getitem__):
            a, b = self.left[i], self.right[i]
            good[i] = good[a] and good[b] and self._border(a, b, self.rank[i])
        built = {piece: i for piece, i in ids.items() if good[i]}
        self.length = [0] * size
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        self.automaton = ahocorasick.Automaton()
        for piece, i in built.items():
            self.length[i] = len(piece)
            self.shorter[i] = next((built[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in built), -1)
            self.automaton.add_word(piece[::-1], i)  # reversed: matches are found by their last character
        self.automaton.make_automaton()

    def _border(self, a: int, b: int, until: int) -> bool:
        """Whether the merges of rank below ``until`` leave the border between the tokens ``a`` and ``b``.

        The pieces at the border are parts of a's right edge and b's left edge, each there from its own
        rank to that of the piece made of it.  A merge across the border happens if it comes while both are
        there; of equal ranks the one further left comes first.
        """
        gone_a = until
        while True:
            c, gone_b = b, until
            while True:
                across = self.merged.get((a, c), self.never)
                if across < gone_a and (across < gone_b or across == gone_b < until):
                    return False
                if self.rank[c] < 0:
                    break
                c, gone_b = self.left[c], self.rank[c]
            if self.rank[a] < 0:
                return True
            a, gone_a = self.right[a], self.rank[a]

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            known = self._border(a, b, self.never)
            if len(self.pairs) < _MOST_PAIRS:
                self.pairs[a, b] = known
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of a word of byte letters."""
        if not word:
            return []
        word += self.end
        n = len(word)
        longest = [-1] * n
        for place, token in self.automaton.iter(word[::-1]):
            if longest[n - 1 - place] < 0:  # the longest comes first
                longest[n - 1 - place] = token
        left = bytearray(n + 1)  # places that no encoding passes through
        if self.end:
            left[n - 1] = 1  # the mark of the end alone is no token
        length, shorter, compatible = self.length, self.shorter, self.compatible
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0 and (left[at + length[token]] or ids and not compatible(ids[-1], token)):
                token = shorter[token]
            if token >= 0:
                ids.append(token)
                at += length[token]
                token = longest[at] if at < n else -1
            else:
                left[at] = 1
                token = ids.pop()
                at -= length[token]
                token = shorter[token]
        return ids


class WordBpe:
    """Texts to ids, and back, by one vocabulary file; a worker keeps ``most`` short chunks at most."""

    def __init__(self, path: str, most: int = 300_000, longest: int = 32):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, normalizer, splitter = described["model"], described["normalizer"], described["pre_tokenizer"]
        names = [part["type"] for part in (normalizer or {}).get("normalizers", [])]
        patterns = [part.get("pattern", {}).get("Regex") for part in (splitter or {}).get("pretokenizers", [])]
        if names != _NORMALIZERS or patterns != [_PATTERN, None]:
            raise ValueError(f"{path} normalises or splits in another way")
        library = Tokenizer.from_file(path)
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.bpe = Backtracking(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.added = {token["content"]: token["id"] for token in described["added_tokens"]}
        self.any_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.letters = byte_letters()
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}
        self.most, self.longest = most, longest
        pieces = {**{i: s for s, i in model["vocab"].items()}, **{i: s for s, i in self.added.items()}}
        blob = [(pieces.get(i, "") + " ").encode() for i in range(max(pieces) + 1)]
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in blob])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(blob), np.uint8)

    def _word(self, word: str) -> bytes:
        """Ids of a word of ordinary, lowered text."""
        return self._piece("".join([self.letters[b] for b in word.encode()]))

    def _piece(self, piece: str) -> bytes:
        ids = self.words.get(piece)
        if ids is None:
            ids = array("I", self.bpe.encode(piece)).tobytes()
            if len(self.words) < self.most and len(piece) <= self.longest:
                self.words[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk and self.any_added.search(chunk):
            parts = self.any_added.split(chunk)
            return b"".join(array("I", [self.added[p]]).tobytes() if p in self.added else self._chunk(p) for p in parts)
        if _COMMON.fullmatch(chunk):
            return b"".join(map(self._word, _SPLIT.findall(chunk.lower())))
        split = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return b"".join([self._piece(piece) for piece, _ in split])

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        known, out = self.chunks, []
        for chunk in text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "):
            ids = known.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(known) < self.most and len(chunk) <= self.longest:
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The tokens' texts in UTF-8 with blanks between them; unknown ids are empty."""
        numbers = np.frombuffer(ids, "<u4")
        if not len(numbers):
            return b""
        numbers = np.where(numbers < len(self.offsets) - 1, numbers, 0)
        starts = self.offsets[numbers]
        lengths = self.offsets[numbers + 1] - starts
        before = np.cumsum(lengths) - lengths
        places = np.repeat(starts - before, lengths) + np.arange(before[-1] + lengths[-1])
        return self.blob[places].tobytes()[:-1]


@lru_cache(maxsize=1)
def words_of(path: str) -> WordBpe:
    """One per Python worker."""
    return WordBpe(path)


def encode(docs: DataFrame, vocabulary: str = WORD_VOCABULARY, key: str = "doc_id") -> DataFrame:
    """key, ids: every whole ``text`` as little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = words_of(vocabulary)
        for batch in slices(batches):
            ids = [bpe.encode(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], [key, "ids"])

    rows = docs.select(key, "text")
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(encoded: DataFrame, vocabulary: str = WORD_VOCABULARY) -> DataFrame:
    """The rows of ``encoded`` with the decoded ``text`` of ``ids`` added; null ids decode to null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = words_of(vocabulary)
        for batch in slices(batches):
            ids = batch.column(batch.schema.get_field_index("ids"))
            texts = [bpe.decode(i.as_py()) if i.is_valid else None for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], [*batch.schema.names, "text"]
            )

    rows = encoded.drop("text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{kinds}, text string")


def digests(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of rows with ``ids`` and the decoded ``text``."""
    return decoded.select(
        key, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
