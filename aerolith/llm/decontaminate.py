"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Each run of five words of a test item is a seed.  A Bloom filter of the seeds, of bounded
   size whatever the benchmark, tells a scan of the training texts which places to look at;
   around those it cuts stretches of words, long ones into overlapping windows of some four items'
   length, so that a document of many items isn't aligned whole with each.  Nothing else of the
   corpus moves.
2. The stretches' n-grams are joined with the seeds by equal keys.  A stretch and an item are
   aligned if they share a seed that few items hold (at most ``rare``) or two different seeds.
   So a phrase of very many items alone starts no alignment; how often the corpus holds a seed
   doesn't matter, and an item that has leaked into very many documents is found in each.
3. Smith-Waterman over words (match 2, mismatch and gap -1), many pairs at a time, gives the
   best local score.  Divided by that of the whole item it is 1 for a verbatim copy; edits
   and left out parts lower it.  At ``least`` or above a document is contaminated.

Words are lower-cased and end at white space or ASCII punctuation.  Null texts have none; items
of fewer than five words carry too little evidence and match nothing.  Repeated rows of
documents or items count once per pair of ids, with the best score.  Only doc_id, item_id and
the texts are read.  Without items, or documents, nothing is contaminated.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import SLICE_CHARS, slices, stored

_SPLIT = bytes(32 if chr(b) in string.punctuation else b for b in range(256))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SALTS = 32
STRETCH = "stretch long, doc_id long, first_word long, words string, grams array<long>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SPLIT).split()


def gram_hashes(words: list[bytes], size: int) -> np.ndarray:
    """64-bit hashes of the runs of ``size`` words."""
    n = len(words) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out = h[:n].copy()
    for k in range(1, size):
        out = out * _FACTOR + h[k : k + n]
    return (out ^ (out >> np.uint64(29))) * _FACTOR


def _bits(hashes: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a filter of 2**power bits."""
    mask = np.uint64((1 << power) - 1)
    return hashes & mask, (hashes >> np.uint64(64 - power)) & mask


class Bloom:
    """At most ``2**27`` bits, 16 MB, however many hashes it holds."""

    def __init__(self, power: int, words: np.ndarray):
        self.power, self.words = power, words

    def __contains__(self, value) -> bool:
        return bool(self.test(np.array([value], np.uint64))[0])

    def test(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in _bits(hashes, self.power):
            found &= (self.words[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found

    @classmethod
    def of(cls, seeds: DataFrame, count: int) -> Bloom:
        """Built by the executors: bytes of the filter are merged by ``bit_or``, at most 2**24 reach the driver."""
        power = min(27, max(22, int(512 * max(1, count)).bit_length()))  # 512 bits a seed, 2**22 at least

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(0).to_numpy().view(np.uint64)
                at = np.concatenate(_bits(hashes, power)).astype(np.int64)
                bit = np.left_shift(1, at & 7)
                yield pa.RecordBatch.from_arrays([pa.array(at >> 3), pa.array(bit.astype(np.int32))], ["at", "bit"])

        rows = seeds.select("gram").mapInArrow(places, "at long, bit int").groupBy("at").agg(F.bit_or("bit").alias("bits"))
        found = rows.toArrow()
        words = np.zeros((1 << power) // 8, np.uint8)
        words[found.column(0).to_numpy()] = found.column(1).to_numpy().astype(np.uint8)
        return cls(power, words)


def seeds_of(items: DataFrame, size: int) -> DataFrame:
    """item (number of an item's text), item_id, words, gram: a row per run of ``size`` words of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, grams = [], [], []
            for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = words_of(text.as_py())
                found = np.unique(gram_hashes(words, size)).view(np.int64).tolist()
                ids += [item_id] * len(found)
                texts += [b" ".join(words).decode()] * len(found)
                grams += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(grams, pa.int64())],
                ["item_id", "item_words", "gram"],
            )

    rows = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "item_id long, item_words string, gram long")


def stretches(docs: DataFrame, bloom: Bloom, size: int, reach: int) -> DataFrame:
    """Parts of documents around n-grams that the filter knows, with ``reach`` words more on both sides."""

    def cut(words: list[bytes], base: int) -> Iterator[tuple[int, str, list[int]]]:
        hashes = gram_hashes(words, size)
        at = np.flatnonzero(bloom.test(hashes))
        if len(at):
            for group in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1):
                low, high = max(0, int(group[0]) - reach), int(group[-1]) + size + reach
                high = min(high, len(words))
                while True:
                    # An alignment that scores enough spans less than two item lengths: it lies in one of these windows.
                    end = min(low + 4 * reach + size, high)
                    inside = group[(group >= low) & (group + size <= end)]
                    if len(inside):
                        grams = np.unique(hashes[inside]).view(np.int64).tolist()
                        yield base + low, b" ".join(words[low:end]).decode("utf-8", "replace"), grams
                    if end == high:
                        break
                    low += 2 * reach

    def parts(text: str) -> Iterator[tuple[int, str, list[int]]]:
        if len(text) <= SLICE_CHARS:
            yield from cut(words_of(text), 0)
            return
        # Very long texts: slices of the words, each with enough of the one before to hold any match.
        data = text.lower().encode().translate(_SPLIT)
        at, base, carry = 0, 0, []
        while at < len(data):
            end = data.find(b" ", at + SLICE_CHARS)
            end = len(data) if end < 0 else end
            words = carry + data[at:end].split()
            yield from cut(words, base)
            keep = min(len(words), 2 * reach + size)
            base, carry, at = base + len(words) - keep, words[len(words) - keep :], end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        names = [c.split()[0] for c in STRETCH.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for first, words, grams in parts(text.as_py() or ""):
                    rows.append((number, doc_id, first, words, grams))
                    number += 1
            if rows:
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, STRETCH)


def align(pairs: list[tuple[list[str], list[str]]], at_once: int = 64) -> list[tuple[int, int]]:
    """Best local score of each (item words, other words), and how many of the other words precede its end."""
    out: list[tuple[int, int]] = [(0, 0)] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda i: len(pairs[i][1]))
    for i in range(0, len(order), at_once):
        some = order[i : i + at_once]
        m, n = max(len(pairs[k][0]) for k in some), max(len(pairs[k][1]) for k in some)
        a, b = np.full((len(some), m), -1, np.int32), np.full((len(some), n), -2, np.int32)
        for row, k in enumerate(some):
            number = {w: j for j, w in enumerate(pairs[k][0])}
            a[row, : len(pairs[k][0])] = [number[w] for w in pairs[k][0]]
            b[row, : len(pairs[k][1])] = [number.get(w, -2) for w in pairs[k][1]]
        steps = np.arange(n, dtype=np.int32)
        above, best, end = np.zeros((len(some), n + 1), np.int32), np.zeros(len(some), np.int32), np.zeros(len(some), np.int64)
        for j in range(m):
            here = above[:, :-1] + np.where(a[:, j : j + 1] == b, 2, -1).astype(np.int32)
            np.maximum(here, above[:, 1:] - 1, out=here)
            np.maximum(here, 0, out=here)
            here = np.maximum.accumulate(here + steps, axis=1) - steps  # gaps within the row
            above[:, 1:] = here
            at = here.argmax(axis=1)
            top = here[np.arange(len(some)), at]
            end = np.where(top > best, at + 1, end)
            best = np.maximum(best, top)
        for row, k in enumerate(some):
            out[k] = (int(best[row]), int(end[row]))
    return out


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        items = [t.split(" ") for t in batch.column("item_words").to_pylist()]
        others = [t.split(" ") for t in batch.column("words").to_pylist()]
        scores = align(list(zip(items, others, strict=True)))
        first = batch.column("first_word").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("item_id"),
                pa.array([s / (2 * len(i)) for (s, _), i in zip(scores, items, strict=True)], pa.float64()),
                pa.array([f + e for (_, e), f in zip(scores, first, strict=True)], pa.int64()),
            ],
            ["doc_id", "item_id", "score", "end_word"],
        )


def contaminated(
    docs: DataFrame, items: DataFrame, size: int = 5, rare: int = 50, least: float = 0.6
) -> DataFrame:
    """doc_id, item_id, score, end_word (words up to the end of the best alignment) of contaminated documents."""
    seeds = stored(seeds_of(items, size).distinct(), "seeds")
    known = seeds.agg(F.count("*").alias("n"), F.max(F.size(F.split("item_words", " "))).alias("m")).first()
    places = stored(stretches(docs, Bloom.of(seeds, known.n), size, known.m or 0), "stretches")
    texts = seeds.select("item_id", "item_words").distinct().withColumn("item", F.xxhash64("item_id", "item_words"))
    by_gram = seeds.select("gram", F.xxhash64("item_id", "item_words").alias("item"))
    grams = places.select("stretch", F.explode("grams").alias("gram"))
    spread = by_gram.groupBy("gram").agg(F.count("*").alias("items"))
    # One passage may be in a third of all documents: its seeds are dealt over many keys.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    known_grams = by_gram.join(spread, "gram").withColumn("salt", salts)
    # Spark sizes a stretch's grams as one row, and its file is small where stretches repeat: neither is broadcast.
    dealt = grams.withColumn("salt", F.pmod("stretch", F.lit(_SALTS)).cast("int"))
    shared = dealt.join(known_grams.hint("merge"), ["gram", "salt"])
    pairs = shared.groupBy("stretch", "item").agg(F.min("items").alias("fewest"), F.countDistinct("gram").alias("n"))
    pairs = pairs.where((F.col("fewest") <= rare) | (F.col("n") >= 2)).select("stretch", "item")
    rows = places.drop("grams").join(pairs.hint("merge"), "stretch").join(texts, "item")
    rows = rows.select("doc_id", "item_id", "first_word", "words", "item_words")
    scored = rows.mapInArrow(_aligned, "doc_id long, item_id long, score double, end_word long")
    best = scored.where(F.col("score") >= least).groupBy("doc_id", "item_id")
    return best.agg(F.max(F.struct("score", (-F.col("end_word")).alias("end"))).alias("_b")).select(
        "doc_id", "item_id", F.col("_b.score").alias("score"), (-F.col("_b.end")).alias("end_word")
    )
