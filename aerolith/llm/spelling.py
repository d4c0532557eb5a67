"""Spelling variants: words that differ by one edit, found by probing Bloom filters of the vocabulary.

1. Words are counted by the tasks and summed up by Spark.
2. The vocabulary is dealt to blocked Bloom filters by length (a length of very many words to
   several, by hash).  Executors build them; filters are broadcast in rounds of a fixed number
   of bytes at most, so that a larger vocabulary means more rounds, not larger broadcasts.
3. Each word generates the edits that its neighbours could be: every deletion, and every
   replacement by a later letter.  (An insertion is a deletion seen from the longer word.)
   Edits are hashed without being built, as a sum over positions of which an edit changes few
   terms.  Only edits that the filters know are built and shuffled.
4. An equality join with the vocabulary removes what the filters let through by mistake.

What the filters hold changes the number of rows that are shuffled, never the result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import slices, stored

LETTERS = "A-Za-z\u00c0-\u00ff"
_UPPER = str.maketrans({c: c + 32 for c in range(65, 91)})
#: A task hands on its counts when it holds so many words.
_MOST_WORDS = 200_000
#: Bits a word, bits set for each, words (64 bits) of a filter, bytes of the filters of a round.
_BITS, _SET, _MOST_BLOCKS, ROUND_BYTES = 24, 4, 1 << 20, 1 << 26
#: Blocks of a filter that one executor's row carries.
_CHUNK = 1 << 13
#: Edits hashed at a time.
_EDITS = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)


def count_words(
    docs: DataFrame, least_length: int = 7, every: int = 31, key: str = "doc_id"
) -> DataFrame:
    """word, n: how often each word of ``least_length`` code points or more occurs in all whole texts.

    A word is a maximal run of letters with A-Z lowered.  With h the crc32 of ``<key>:<word>``, a word of h
    divisible by ``every`` (if not 0) loses its code point number h % length: seeded misspellings, the same
    whatever the partitioning.  A null key is written as nothing.  Null texts have no words.
    """
    # A run that is too short can't become long enough.
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return batch

        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{doc_id.as_py()}:".encode() if doc_id.is_valid else b":")
                for found in runs.finditer(text.as_py().translate(_UPPER)):
                    word = found[0]
                    if every:
                        h = zlib.crc32(word.encode(), seed)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    held[word] = held.get(word, 0) + 1
                    if len(held) >= _MOST_WORDS:
                        yield flush()
        if held:
            yield flush()

    rows = docs.select(key, "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


# --- hashes of words and their edits ------------------------------------------------------


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _terms(positions: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What a letter at a position adds to its word's hash."""
    return _mixed((positions.astype(np.uint64) << np.uint64(21) | letters.astype(np.uint64)) * _MIX + _MIX)


def _letters(words: Sequence[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), length)


def word_hashes(letters: np.ndarray) -> np.ndarray:
    """Hashes of words of one length, a row of code points each."""
    out = np.zeros(len(letters), np.uint64)
    for i in range(letters.shape[1]):
        out += _terms(np.full(len(letters), i), letters[:, i])
    return out


def deletions(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, position, hash) of each different word with one letter less: of equal letters in a row the first goes."""
    rows, length = letters.shape
    at = np.arange(length)
    here = _terms(np.broadcast_to(at, letters.shape), letters)
    left = _terms(np.broadcast_to(np.maximum(at - 1, 0), letters.shape), letters)  # moved one place to the left
    head = np.cumsum(here, axis=1) - here
    tail = np.cumsum(left[:, ::-1], axis=1)[:, ::-1] - left
    different = np.ones(letters.shape, bool)
    different[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, position = np.nonzero(different)
    return row, position, (head + tail)[row, position]


def replacements(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, position, new letter, hash) of the words with one letter replaced by a later one of the sorted alphabet."""
    rows, length = letters.shape
    whole = word_hashes(letters)
    step = max(1, _EDITS // max(1, len(alphabet)))
    for start in range(0, rows * length, step):
        cell = np.arange(start, min(start + step, rows * length))
        row, position = cell // length, cell % length
        old = letters[row, position]
        many = len(alphabet) - np.searchsorted(alphabet, old, "right")  # later letters
        base = whole[row] - _terms(position, old)
        which = np.repeat(np.arange(len(cell)), many)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        new = alphabet[np.repeat(len(alphabet) - many, many) + nth]
        yield row[which], position[which], new, base[which] + _terms(position[which], new)


# --- filters ------------------------------------------------------------------------------


def _places(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, mask): the block of 64 bits of each hash, and its bits there."""
    mixed = _mixed(hashes * _MIX)
    block = ((mixed >> np.uint64(40)) * np.uint64(blocks)) >> np.uint64(24)
    mask = np.zeros(len(mixed), np.uint64)
    for k in range(_SET):
        mask |= np.uint64(1) << (mixed >> np.uint64(6 * k) & np.uint64(63))
    return block.astype(np.int64), mask


class Filters:
    """The blocked filters of some lengths: (length, part) -> blocks; a length has ``parts`` of them."""

    def __init__(self, parts: dict[int, int], blocks: dict[tuple[int, int], np.ndarray]):
        self.parts, self.blocks = parts, blocks

    def lengths(self) -> set[int]:
        return {length for length, _ in self.blocks}

    def test(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """Whether words of these hashes can be in a filter of this round."""
        found = np.zeros(len(hashes), bool)
        own = part_of(hashes, self.parts[length])
        for (n, part), blocks in self.blocks.items():
            if n == length:
                here = np.nonzero(own == part)[0]
                block, mask = _places(hashes[here], len(blocks))
                found[here] = blocks[block] & mask == mask
        return found


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (_mixed(hashes ^ _MIX) % np.uint64(parts)).astype(np.int64) if parts > 1 else np.zeros(len(hashes), np.int64)


def layout(counts: dict[int, int], most_blocks: int = _MOST_BLOCKS, round_bytes: int = ROUND_BYTES):
    """(parts of each length, blocks of each length's filters, rounds): what is broadcast together.

    A filter has ``most_blocks`` blocks at most, a round's filters ``round_bytes``, unless one alone has more.
    """
    parts, blocks, rounds, room = {}, {}, [], 0
    for length, words in sorted(counts.items()):
        need = max(1, -(-words * _BITS // 64))
        parts[length] = -(-need // most_blocks)
        blocks[length] = -(-need // parts[length])
        for part in range(parts[length]):
            if 8 * blocks[length] > room:
                rounds.append([])
                room = round_bytes
            rounds[-1].append((length, part))
            room -= 8 * blocks[length]
    return parts, blocks, rounds


def build_filters(vocabulary: DataFrame, parts: dict[int, int], blocks: dict[int, int], wanted: list[tuple[int, int]]) -> Filters:
    """The filters of a round, built by the executors; their bytes, bounded by ``layout``, reach the driver."""
    chosen = set(wanted)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, words in by_length(batch.column(0).to_pylist()):
                hashes = word_hashes(_letters(words, length))
                own = part_of(hashes, parts[length])
                for part in range(parts[length]):
                    if (length, part) in chosen and (own == part).any():
                        block, mask = _places(hashes[own == part], blocks[length])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(block), length), pa.int32()), pa.array(np.full(len(block), part), pa.int32()),
                                pa.array(block, pa.int64()), pa.array(mask.view(np.int64), pa.int64()),
                            ],
                            ["length", "part", "block", "mask"],
                        )

    def dense(key: tuple, rows: pa.Table) -> pa.Table:
        length, part, chunk = (k.as_py() for k in key)
        bits = np.zeros(min(_CHUNK, blocks[length] - chunk * _CHUNK), np.uint64)
        np.bitwise_or.at(bits, rows.column("block").to_numpy() - chunk * _CHUNK, rows.column("mask").to_numpy().view(np.uint64))
        return pa.table({"length": [length], "part": [part], "chunk": [chunk], "bits": [bits.tobytes()]}, schema=kinds)

    kinds = pa.schema([("length", pa.int32()), ("part", pa.int32()), ("chunk", pa.int64()), ("bits", pa.binary())])
    lengths = sorted({length for length, _ in wanted})
    rows = vocabulary.where(F.length("word").isin(lengths)).select("word")
    rows = rows.mapInArrow(places, "length int, part int, block long, mask long")
    # A chunk takes the words that hash to its blocks, about _CHUNK * 64 / _BITS.
    chunks = rows.groupBy("length", "part", F.floor(F.col("block") / _CHUNK).alias("chunk"))
    found = chunks.applyInArrow(dense, "length int, part int, chunk long, bits binary").collect()
    filters = {(n, p): np.zeros(blocks[n], np.uint64) for n, p in wanted}
    for row in found:
        bits = np.frombuffer(row.bits, np.uint64)
        filters[row.length, row.part][row.chunk * _CHUNK : row.chunk * _CHUNK + len(bits)] = bits
    return Filters(parts, filters)


def by_length(words: Sequence[str]) -> Iterator[tuple[int, list[str]]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    yield from groups.items()


def letters_of(vocabulary: DataFrame) -> np.ndarray:
    """The code points in use, sorted; no more than the runs' pattern allows."""

    def used(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[str] = set()
        for batch in batches:
            known.update(*batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(map(ord, known)), pa.int32())], ["letter"])

    rows = vocabulary.select("word").mapInArrow(used, "letter int").distinct().collect()
    return np.array(sorted(row.letter for row in rows), np.uint32)


# --- neighbours ---------------------------------------------------------------------------


def candidates(vocabulary: DataFrame, filters: Filters, alphabet: np.ndarray) -> DataFrame:
    """word, n, near: the edits of each word that the filters know."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(filters)
    lengths = filters.lengths()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            counts = dict(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for length, words in by_length(list(counts)):
                step = max(1, _EDITS // length)
                for start in range(0, len(words), step):
                    part = words[start : start + step]
                    for found in edits(part, length, known):
                        if found:
                            row, near = zip(*found)
                            mine = [part[i] for i in row]
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array(mine, pa.string()), pa.array([counts[w] for w in mine], pa.int64()),
                                    pa.array(near, pa.string()),
                                ],
                                ["word", "n", "near"],
                            )

    def edits(words: list[str], length: int, known: Filters) -> Iterator[list[tuple[int, str]]]:
        letters = _letters(words, length)
        if length - 1 in lengths:
            row, position, hashes = deletions(letters)
            hit = np.nonzero(known.test(length - 1, hashes))[0]
            yield [(r, words[r][:p] + words[r][p + 1 :]) for r, p in zip(row[hit].tolist(), position[hit].tolist())]
        if length in lengths:
            for row, position, new, hashes in replacements(letters, alphabet):
                hit = np.nonzero(known.test(length, hashes))[0]
                found = zip(row[hit].tolist(), position[hit].tolist(), map(chr, new[hit].tolist()))
                yield [(r, words[r][:p] + c + words[r][p + 1 :]) for r, p, c in found]

    wide = sorted(lengths | {n + 1 for n in lengths})
    rows = vocabulary.where(F.length("word").isin(wide)).select("word", "n")
    return rows.mapInArrow(probe, "word string, n long, near string")


def neighbours(vocabulary: DataFrame, **bounds: int) -> DataFrame:
    """word, n, near, near_n: each pair of words one edit apart, once (``near`` is shorter, or later in order)."""
    counts = vocabulary.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("n")).collect()
    parts, blocks, rounds = layout({row.length: row.n for row in counts}, **bounds)
    alphabet = letters_of(vocabulary)
    found = None
    for wanted in rounds:
        hits = candidates(vocabulary, build_filters(vocabulary, parts, blocks, wanted), alphabet)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = vocabulary.select("word", "n", F.col("word").alias("near")).limit(0)
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return found.join(known, "near").select("word", "n", "near", "near_n")


# --- forms and roots ----------------------------------------------------------------------


def group_variants(words: DataFrame, least_count: int = 2, ratio: int = 10, **bounds: int) -> DataFrame:
    """word, n, n_near, form, form_n, root for the words (word, n) that occur ``least_count`` times or more.

    A word's form is its near word of largest n (ties: the smaller word), if that is ``ratio`` times its own n
    or more; the root is where following forms ends.  ``words`` holds each word once; empty and null words are
    left out.  An empty table gives an empty table.
    """
    rows = words.where((F.col("n") >= least_count) & (F.length("word") > 0)).select("word", F.col("n").cast("long").alias("n"))
    vocabulary = stored(rows, "spelling-words")
    pairs = stored(neighbours(vocabulary, **bounds), "spelling-pairs")
    there = pairs.select("word", "near", "near_n")
    back = pairs.select(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = there.unionByName(back).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    large = -F.col("best.minus")
    joined = vocabulary.join(best, "word", "left")
    forms = stored(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(large >= ratio * F.col("n"), F.col("best.near")).alias("form"),
            F.when(large >= ratio * F.col("n"), large).alias("form_n"),
        ),
        "spelling-forms",
    )
    return forms.join(roots(forms, ratio), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """word, root of the words with a form, by doubling the reach of each link.

    n grows ``ratio`` times with each link, hence a chain has at most log(largest n) links, and the number of
    doublings is known beforehand.
    """
    links = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    top = forms.agg(F.max("n")).first()[0] or 1
    longest = 0
    while ratio ** (longest + 1) <= top:
        longest += 1
    reach = 1
    while reach < longest:
        links = stored(links, "spelling-links")
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        links = links.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root"))
        reach *= 2
    return links
