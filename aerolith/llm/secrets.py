"""Secret scans: fixed patterns, and character Markov models for random strings.

Two Markov models of third order statistics, one of random strings and one of ordinary
identifiers, score every run of key characters that no pattern covers.  The parts of a run
between ``/ _ - =`` are scored one by one: neighbours whose log-likelihood ratio per character
together exceeds a threshold are a span of kind ``markov``, so words before or behind a key
neither hide it nor belong to its span.

Null text is empty text: no span.  Offsets are code points, ends exclusive.  Rows are judged
one by one, so ties, repeated rows and ids change nothing; only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import slices

# What the base patterns are and how long a match must be.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = re.compile(rb"[A-Za-z0-9+/_=-]+")
_PIECE = re.compile(rb"[A-Za-z0-9+]+|[/_=-]+")
#: A piece of so few characters, or of no worse a ratio below the threshold, says too little to be cut off the key beside it.
_SHORT_PIECE, _UNSURE = 3, -0.3
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _members(characters: bytes) -> bytes:
    """Translation table: 1 for ``characters``, 0 for all else."""
    return bytes(int(b in characters) for b in range(256))


_IS_HEX, _IS_RUN = _members(b"0123456789abcdef"), _members(ALPHABET)
_CODE = np.full(256, -1, np.int64)
_CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))

Span = tuple[int, int, int]  # start, kind, end


def code_points(text: str | None) -> bytes:
    """One byte per code point: itself up to 255, else a question mark, which no pattern here takes."""
    return (text or "").encode("latin-1", "replace")


def base_spans(data: bytes) -> list[Span]:
    """Matches of the fixed patterns, leftmost and not overlapping within a kind; the short ones are dropped."""
    spans = []
    lower = data.lower()
    if any(word in lower for word in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(data) if len(m[2]) >= LEAST_VALUE]
    if b"AKIA" in data:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(data) if m.end() - m.start() >= LEAST_ACCESS]
    if b"\1" * LEAST_HEX in data.translate(_IS_HEX):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(data) if m.end() - m.start() >= LEAST_HEX]
    return sorted(spans)


def runs(data: bytes, least: int) -> list[tuple[int, int]]:
    """Whole runs of key characters, ``least`` or longer."""
    if b"\1" * least not in data.translate(_IS_RUN):
        return []
    return [m.span() for m in _RUN.finditer(data) if m.end() - m.start() >= least]


@dataclass(frozen=True)
class Markov:
    """log P(character | two before), smoothed by the shorter contexts; index len(ALPHABET) stands for the start."""

    logs: np.ndarray

    @classmethod
    def fit(cls, strings: list[bytes], strength: float = 4.0) -> Markov:
        k = len(ALPHABET)
        one, two, three = np.zeros(k), np.zeros((k + 1, k)), np.zeros((k + 1, k + 1, k))
        for s in strings:
            c = _codes(s)
            np.add.at(one, c[2:], 1)
            np.add.at(two, (c[1:-1], c[2:]), 1)
            np.add.at(three, (c[:-2], c[1:-1], c[2:]), 1)
        p1 = 0.9 * (one + strength / k) / (one.sum() + strength) + 0.1 / k
        p2 = (two + strength * p1) / (two.sum(1, keepdims=True) + strength)
        p3 = (three + strength * p2) / (three.sum(2, keepdims=True) + strength)
        return cls(np.log(0.98 * p3 + 0.02 / k).astype(np.float32))  # nothing is impossible

    def score(self, s: bytes) -> float:
        c = _codes(s)
        return float(self.logs[c[:-2], c[1:-1], c[2:]].sum(dtype=np.float64))


def _codes(s: bytes) -> np.ndarray:
    k = len(ALPHABET)
    return np.concatenate([[k, k], _CODE[np.frombuffer(s, np.uint8)]])


@dataclass(frozen=True)
class SecretModel:
    random: Markov
    ordinary: Markov
    threshold: float  # log-likelihood ratio per character
    least: int  # characters of a run

    def ratio(self, s: bytes) -> float:
        return (self.random.score(s) - self.ordinary.score(s)) / len(s)

    def segments(self, s: bytes) -> list[tuple[int, int]]:
        """Maximal sequences of pieces of a run whose ratio exceeds the threshold, ``least`` or more characters each.

        Ruzzo and Tompa's linear method over the pieces' sums.  A run that only as a whole is long
        and random enough is one segment.
        """
        codes = _codes(s)
        excess = (self.random.logs - self.ordinary.logs)[codes[:-2], codes[1:-1], codes[2:]] - self.threshold
        sums = np.concatenate([[0.0], np.cumsum(excess, dtype=np.float64)])
        pieces = [m.span() for m in _PIECE.finditer(s)]
        found: list[tuple[int, int, int]] = []  # first piece, last piece, place of the nearest one that begins lower
        for k, (start, end) in enumerate(pieces):
            if sums[end] <= sums[start]:
                continue
            first, j = k, len(found) - 1
            while True:
                while j >= 0 and sums[pieces[found[j][0]][0]] >= sums[pieces[first][0]]:
                    j = found[j][2]
                if j < 0 or sums[pieces[found[j][1]][1]] >= sums[end]:
                    found.append((first, k, j))
                    break
                first, before = found[j][0], found[j][2]
                del found[j:]
                j = before
        out: list[tuple[int, int]] = []
        for first, last, _ in found:
            if pieces[last][1] - pieces[first][0] < self.least:
                continue
            first, last = self._with_unsure_pieces(sums, pieces, first, last)
            if out and pieces[first][0] < out[-1][1]:
                out[-1] = (out[-1][0], pieces[last][1])
            else:
                out.append((pieces[first][0], pieces[last][1]))
        return out or ([(0, len(s))] if sums[-1] > 0 else [])

    def _with_unsure_pieces(self, sums: np.ndarray, pieces: list[tuple[int, int]], first: int, last: int) -> tuple[int, int]:
        """A segment and the unsure pieces beside it, while it stays above the threshold: a key may hold a ``/``."""

        def unsure(k: int) -> bool:
            low, high = pieces[k]
            return high - low <= _SHORT_PIECE or sums[high] - sums[low] > _UNSURE * (high - low)

        while first >= 2 and unsure(first - 2) and sums[pieces[last][1]] > sums[pieces[first - 2][0]]:
            first -= 2
        while last + 2 < len(pieces) and unsure(last + 2) and sums[pieces[last + 2][1]] > sums[pieces[first][0]]:
            last += 2
        return first, last

    def spans(self, data: bytes) -> list[Span]:
        """Base spans, and what looks random in the runs outside them."""
        spans = base_spans(data)
        added = []
        for start, end in runs(data, self.least):
            for low, high in _outside(start, end, spans):
                if high - low >= self.least:
                    added += [(low + a, 3, low + b) for a, b in self.segments(data[low:high])]
        return sorted(spans + added)


def _outside(start: int, end: int, spans: list[Span]) -> list[tuple[int, int]]:
    """The parts of a range that no span touches; ``spans`` by start."""
    out = []
    for s, _, e in spans:
        if s < end and start < e:
            out.append((start, s))
            start = e
    return [*out, (start, end)]


def made_secrets(rng: np.random.Generator, count: int) -> list[bytes]:
    """Random strings over the alphabets that keys are written in."""
    lower, upper, digits = ALPHABET[26:52], ALPHABET[:26], ALPHABET[52:62]
    kinds = (digits + b"abcdef", upper + digits, lower + digits, upper + lower + digits, ALPHABET[:64])
    out = []
    for i in range(count):
        letters = np.frombuffer(kinds[i % len(kinds)], np.uint8)
        out.append(rng.choice(letters, rng.integers(16, 65)).tobytes())
    return out


def joined_words(rng: np.random.Generator, words: list[bytes], count: int) -> list[bytes]:
    """Ordinary identifiers: words as they stand, and two to four of them joined as code joins them."""
    if not words:
        return []
    out = list(words)
    for i in range(count):
        some = [words[k] for k in rng.integers(0, len(words), rng.integers(2, 5))]
        style = i % 4
        if style == 0:
            out.append(b"_".join(some).lower())
        elif style == 1:
            out.append(b"".join(w.capitalize() for w in some))
        elif style == 2:
            out.append(b"-".join(some).lower() + str(rng.integers(0, 3000)).encode())
        else:
            out.append(b"/".join(some))
    return out


def repeated_patterns(rng: np.random.Generator, count: int) -> list[bytes]:
    """Rules and fill characters: one to three characters over and over."""
    letters = np.frombuffer(ALPHABET, np.uint8)
    return [(rng.choice(letters, 1 + i % 3).tobytes() * 40)[: rng.integers(16, 60)] for i in range(count)]


def labelled_strings(docs: DataFrame, documents: int = 2000) -> tuple[list[bytes], list[bytes]]:
    """Secrets and ordinary words of a hash sample of about ``documents`` documents.

    The label is what the base patterns say: what they cover is a secret, other runs of letters are not.
    At most 200 words of a document are taken.
    """

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[bool, bytes]] = []
            for text in batch.column(0):
                data = code_points(text.as_py())
                spans = base_spans(data)
                rows += [(True, max(_RUN.findall(data[s:e]), key=len)) for s, _, e in spans]
                for s, _, e in reversed(spans):
                    data = data[:s] + b" " + data[e:]
                rows += [(False, w) for w in dict.fromkeys(re.findall(rb"[A-Za-z]{2,}", data))][:200]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.bool_()), pa.array([r[1] for r in rows], pa.binary())], ["secret", "s"]
            )

    total = docs.count()
    if not total:
        return [], []
    scale = 1 << 30
    # Null ids would all hash alike; an id of very many rows counts with a bounded number of them.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    share = F.pmod(spread, F.lit(scale)) < int(min(1.0, documents / total) * scale) + (documents >= total)
    sample = docs.where(share)
    if sample.count() > 4 * documents:
        each = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
        sample = sample.withColumn("_copy", F.row_number().over(each)).where("_copy = 1").drop("_copy").limit(4 * documents)
    found = sample.select("text").mapInArrow(strings, "secret boolean, s binary").distinct().toArrow()
    pairs = sorted(zip(found.column(0).to_pylist(), found.column(1).to_pylist()))
    return [s for secret, s in pairs if secret], [s for secret, s in pairs if not secret]


def fit(docs: DataFrame, documents: int = 2000, least: int = 20, threshold: float = 0.5, seed: int = 7) -> SecretModel:
    """Train both models on labelled strings of about ``documents`` documents and on strings made from a seed."""
    rng = np.random.default_rng(seed)
    secrets, words = labelled_strings(docs, documents)
    words = words or [b"value", b"name", b"index", b"count", b"table", b"result"]
    return SecretModel(
        Markov.fit(secrets + made_secrets(rng, 4000)),
        Markov.fit(joined_words(rng, words, 8000) + repeated_patterns(rng, 4000)),
        threshold,
        least,
    )


def scan(docs: DataFrame, model: SecretModel) -> DataFrame:
    """doc_id, spans: array of (kind, start, end) of every whole text, by start, then kind as listed in KINDS."""
    kind = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(1):
                spans = model.spans(code_points(text.as_py()))
                found.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(struct))], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, kind)


def redact(docs: DataFrame, model: SecretModel, mark: str = "[secret]") -> DataFrame:
    """``docs`` with each span, or chain of overlapping spans, of ``text`` replaced by ``mark``; null text stays null."""

    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else _redacted(t, model, mark) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _redacted(text: str, model: SecretModel, mark: str) -> str:
    out, at = [], 0
    for start, _, end in model.spans(code_points(text)):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text
