"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into so few segments that two fingerprints within ``radius``
bits differ by at most one bit in one of them (two segments for a radius of 3).  Each segment
is indexed once per bit with that bit as a wildcard: 64 keys a fingerprint.  Equal keys meet in
a join whose condition also verifies the whole distance and keeps one of the keys that a pair
shares, so that the join gives each linked pair once.  Only different fingerprints take part:
copies are grouped before.  Components come from rounds of star contraction.

Words are runs without ASCII white space, A-Z in lower case.  Fewer words than a shingle: the
whole sequence is hashed; no word (also null text): fingerprint zero, linked like any other.
Repeated ids are rows of their own, not linked by their id.  Null ids are no component's
smallest id unless it has no other.  Only doc_id and text are read; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from aerolith.llm.common import SLICE_CHARS, grouped_by_size, slices, stored

SEED = 42
_SPACE = re.compile(rb"[ \t-\r]")
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, size: int = 3) -> np.ndarray:
    """XXH64 of the shingles of ``size`` words, repeats included."""
    data, at, carry, found = (text or "").encode().lower(), 0, [], []
    while at < len(data):  # slices, for very long texts
        end = at + SLICE_CHARS
        end = space.start() if end < len(data) and (space := _SPACE.search(data, end)) else len(data)
        words = carry + data[at:end].split()
        if len(words) >= size:
            shingles = map(b" ".join, zip(*(words[k:] for k in range(size))))
            found.append(np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(words) - size + 1))
            carry = words[-(size - 1) :]
        else:
            carry = words
        at = end
    if not found and carry:
        return np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], np.uint64)
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def majority_bits(hashes: list[np.ndarray]) -> np.ndarray:
    """For each array the number whose bits are set in over half of its hashes; zero for an empty one.

    Eight counters share a word of 64 bits; after 255 hashes they are added to wider ones.
    """
    sizes = np.array([len(h) for h in hashes])
    out = np.zeros(len(hashes), np.uint64)
    kept = np.flatnonzero(sizes)
    if not len(kept):
        return out
    n, values = sizes[kept], np.concatenate(hashes)
    blocks = -(-n // 255)
    first = np.cumsum(blocks) - blocks
    starts = np.repeat(np.cumsum(n) - n, blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(first, blocks))
    bits = np.zeros(len(kept), np.uint64)
    for k in range(8):
        lanes = np.add.reduceat((values >> np.uint64(k)) & _LANES, starts)
        counts = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
        more = 2 * counts > n[:, None]
        for byte in range(8):
            bits |= more[:, byte].astype(np.uint64) << np.uint64(8 * byte + k)
    out[kept] = bits
    return out


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id, fp: the fingerprint of every whole text as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in grouped_by_size(texts):
                found = majority_bits([shingle_hashes(t, shingle_words) for t in texts[i:j]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(found.view(np.int64))], ["doc_id", "fp"]
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _segments(radius: int, bits: int = 64) -> list[tuple[int, int]]:
    """Bit ranges, so many that one of them differs by at most one bit."""
    count = radius // 2 + 1
    return [(bits * k // count, bits * (k + 1) // count) for k in range(count)]


def _mask(low: int, high: int) -> Column:
    value = (1 << high) - (1 << low)
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """a, b: each pair of different fingerprints (column ``fp``, distinct) within ``radius`` bits once, a < b."""
    segments = _segments(radius)

    def of_bit(bit: str, values: list[Column]) -> Column:
        chosen = values[-1]
        for (_, high), value in reversed(list(zip(segments[:-1], values[:-1], strict=True))):
            chosen = F.when(F.col(bit) < high, value).otherwise(chosen)
        return chosen

    masks = [_mask(*s) for s in segments]
    keyed = nodes.select("fp", F.explode(F.array(*[F.lit(i) for i in range(64)])).alias("bit"))
    wild = F.expr("shiftleft(1L, bit)")
    segment = F.col("fp").bitwiseAND(of_bit("bit", masks))
    keyed = keyed.select("fp", "bit", segment.bitwiseAND(F.bitwise_not(wild)).alias("key"))
    left = keyed.select(F.col("fp").alias("a"), "bit", "key")
    right = keyed.select(F.col("fp").alias("b"), F.col("bit").alias("bit_b"), F.col("key").alias("key_b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    here = x.bitwiseAND(of_bit("bit", masks))
    lowest = of_bit("bit", [F.lit(low) for low, _ in segments])
    # One shared key stands for a pair: its first segment with at most one differing bit, the
    # wildcard at that bit, or at the segment's lowest bit where the segment is equal.
    one_key = (here == wild) | ((here == 0) & (F.col("bit") == lowest))
    first_segment = F.lit(True)
    for (_, high), mask in zip(segments[:-1], masks[:-1], strict=True):
        first_segment = first_segment & ((F.col("bit") < high) | (F.bit_count(x.bitwiseAND(mask)) > 1))
    near = F.bit_count(x) <= radius
    meet = (F.col("bit") == F.col("bit_b")) & (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b"))
    # Spark sizes the 64 rows of a fingerprint as one; it would broadcast them while the file of fingerprints is small.
    return left.join(right.hint("merge"), meet & one_key & first_segment & near).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component for every node of an edge (columns a, b), in rounds of star contraction.

    A round joins each node's larger neighbours, then its smaller ones, to the smallest; only
    minima are aggregated, so a node with many neighbours needs no list of them.
    """
    edges = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        joined = large.join(least, "b")
        small = joined.select(F.col("m").alias("a"), "b").unionByName(
            joined.where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        )
        edges = stored(small.distinct(), "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            roots = edges.select("a").distinct()
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                roots.select(F.col("a").alias("node"), F.col("a").alias("root"))
            )
        before = state


def _rooted(docs: DataFrame, radius: int, shingle_words: int) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the component), component_id per row of ``docs``."""
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-classes")
    roots = components(links(nodes, radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    linked = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(linked, "root").select("fp", "root", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, radius: int = 3, shingle_words: int = 3) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links, its own included) per row of ``docs``."""
    return _rooted(docs, radius, shingle_words).drop("root")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _with_fingerprint(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``docs`` and ``_fp``, each row's fingerprint."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            found = [majority_bits([shingle_hashes(t, shingle_words)])[0] for t in texts]
            yield batch.append_column("_fp", pa.array(np.array(found, np.uint64).view(np.int64)))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("_fp", LongType())]))


def one_of_each(docs: DataFrame, radius: int = 3, shingle_words: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id, any one of them if several have this id.

    Rows with a null id stay. Only ids of rows that go are joined with the rows, which keep their columns; rows
    whose id is not theirs alone are told apart by their fingerprints.
    """
    found = stored(_rooted(docs, radius, shingle_words), "near-duplicates")
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    gone = stored(gone, "copies")
    twice = found.groupBy(F.col("doc_id").alias("_twice")).agg(F.count("*").alias("n")).where("n > 1 and _twice is not null")
    twice = stored(twice.select("_twice"), "repeated-ids")
    kept = docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    if twice.isEmpty():
        return kept
    again = F.col("doc_id") == F.col("_twice")
    first = found.join(twice, again, "left_semi").where(F.col("doc_id") == F.col("component_id"))
    first = first.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_own"), F.col("root").alias("_root")).distinct()
    rows = _with_fingerprint(docs.join(twice, again, "left_semi"), shingle_words)
    once = rows.join(first, (F.col("doc_id") == F.col("_id")) & (F.col("_fp") == F.col("_own"))).dropDuplicates(["_root"])
    return kept.join(twice, again, "left_anti").unionByName(once.select(*docs.columns))
