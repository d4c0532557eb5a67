"""Token files with directly addressable codes.

An id is cut into chunks of eight bits, lowest first.  Level k holds chunk k of every id that
reaches it, a bitmap with one bit per chunk tells whether the id goes on at level k + 1, and a
rank directory (set bits before every 512th bit) finds an id's place there.  Any token is read
by one lookup per level; nothing else is decoded.

A file set is a folder of Parquet files, one row per segment of about a million tokens, in
ascending order of doc_id; a document is never cut.  ``part`` and ``segment`` order the rows.
Documents of equal id stand next to each other, ordered by xxhash64 of their text; a null id
comes first.  Null text has the end id alone.  An empty table gives no segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.llm.common import new_path, slices, stored
from aerolith.llm.tokens import VOCABULARY, encoder

_BLOCK = 512
#: Of so many segments, 20 bytes each, the starts are broadcast; with more, of a trillion ids, they are joined by shuffle.
_MOST_STARTS = 1 << 20
#: Bytes of text that a task encodes, about, while that makes no more than so many tasks; words that a worker remembers.
_PART_BYTES, _MOST_PARTS, _MOST_WORDS = 1 << 23, 50_000, 600_000
SEGMENT = (
    "part int, segment int, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
    "levels array<binary>, bitmaps array<binary>, ranks array<binary>"
)


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories of unsigned ids, by level; the last level has no bitmap."""
    levels, bitmaps, ranks, rest = [], [], [], np.asarray(ids, np.uint32)
    while True:
        levels.append((rest & 255).astype(np.uint8).tobytes())
        more = rest > 255
        if not more.any():
            return levels, bitmaps, ranks
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        counts = np.add.reduceat(more, np.arange(0, len(more), _BLOCK), dtype=np.uint64)
        ranks.append(np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u8").tobytes())
        rest = rest[more] >> 8


def decode(levels: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    at = len(levels) - 1
    ids = np.frombuffer(levels[at], np.uint8).astype(np.uint32)
    for chunks, bits in zip(reversed(levels[:at]), reversed(bitmaps), strict=True):
        low = np.frombuffer(chunks, np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(low), bitorder="little").view(bool)
        low[more] |= ids << 8
        ids = low
    return ids


def token_at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], i: int) -> int:
    """Id number ``i`` of a segment, read without decoding its neighbours."""
    value, shift = 0, 0
    for k, chunks in enumerate(levels):
        value |= chunks[i] << shift
        if k == len(bitmaps) or not bitmaps[k][i >> 3] >> (i & 7) & 1:
            return value
        block = i // _BLOCK
        before = int.from_bytes(bitmaps[k][block * _BLOCK // 8 : (i >> 3) + 1], "little")
        before &= (1 << (i - block * _BLOCK)) - 1
        i = int.from_bytes(ranks[k][8 * block : 8 * block + 8], "little") + before.bit_count()
        shift += 8
    raise ValueError("the last level goes on")


def _segment(part: int, segment: int, documents: list[tuple[int | None, bytes]]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(b for _, b in documents), "<u4")
    row = (
        part, segment, len(ids), [d for d, _ in documents], [len(b) // 4 for _, b in documents], *encode(ids)
    )
    kinds = (
        pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.list_(pa.binary())] * 3
    )
    names = [column.split()[0] for column in SEGMENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str = VOCABULARY,
    end_id: int = 2,
    segment_tokens: int = 1 << 20,
) -> None:
    """Encode every whole ``text``, append ``end_id`` and write the segments to the folder ``path``.

    Texts are dealt by ranges of doc_id, as many as their bytes need; each task encodes its range in order and
    holds one segment.
    """
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = TaskContext.get().partitionId(), encoder(vocabulary, _MOST_WORDS)
        held, size, segment = [], 0, 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.encode(text.as_py()) + end
                held.append((doc_id, ids))
                size += len(ids) // 4
                if size >= segment_tokens:
                    yield _segment(part, segment, held)
                    held, size, segment = [], 0, segment + 1
        if held:
            yield _segment(part, segment, held)

    order = ["doc_id", "_tie"]
    rows = docs.select("doc_id", "text").withColumn("_tie", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(_MOST_PARTS, -(-size // _PART_BYTES) or 1)
    rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(segments, SEGMENT).write.parquet(path)


def _shared(starts: DataFrame) -> DataFrame:
    """The segments' starts, broadcast if they are few: then no file is shuffled for the sake of one number."""
    starts = stored(starts, "segment-starts")
    return F.broadcast(starts) if starts.count() <= _MOST_STARTS else starts


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """part, segment, start: how many ids stand before each segment, from the segments' sizes alone.

    The parts' sums, one row a file, are the only rows that are ordered in one task.
    """
    sizes = spark.read.schema(SEGMENT).parquet(path).select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(within), F.lit(0)))
    return inside.join(parts, "part").select("part", "segment", (F.col("part_start") + F.col("inside")).alias("start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit), decoded from the files."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["levels"], row["bitmaps"]).astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                for i in range(0, len(ends), 256):  # small batches: ids take four bytes each now
                    part = slice(i, i + 256)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["doc_ids"][part], pa.int64()),
                            pa.array(starts[part] + row["start"], pa.int64()),
                            pa.array(row["doc_tokens"][part], pa.int64()),
                            pa.array([ids[s:e].tobytes() for s, e in zip(starts[part], ends[part])], pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    rows = spark.read.schema(SEGMENT).parquet(path).join(_shared(segment_starts(spark, path)), ["part", "segment"])
    rows = rows.select("doc_ids", "doc_tokens", "levels", "bitmaps", "start")
    return rows.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def lookup(spark: SparkSession, path: str, positions: DataFrame, bucket: int = 1 << 20) -> DataFrame:
    """position, id for a DataFrame of global positions (column ``position``); positions outside the files vanish.

    A segment is listed under each bucket of positions that it touches, so the join is one of equal keys.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            found = [token_at(r["levels"], r["bitmaps"], r["ranks"], r["position"] - r["start"]) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.int64())], ["position", "id"]
            )

    segments = spark.read.schema(SEGMENT).parquet(path).join(_shared(segment_starts(spark, path)), ["part", "segment"])
    touched = F.sequence(F.floor(F.col("start") / bucket), F.floor((F.col("start") + F.col("n_ids") - 1) / bucket))
    segments = segments.withColumn("_bucket", F.explode(touched))
    wanted = positions.select(F.col("position").cast("long")).withColumn("_bucket", F.floor(F.col("position") / bucket))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_ids"))
    hits = wanted.join(segments, "_bucket").where(inside)
    return hits.select("position", "start", "levels", "bitmaps", "ranks").mapInArrow(read, "position long, id long")


def token_files(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``docs`` and return what the files say (see ``read_documents``)."""
    path = path or new_path(docs.sparkSession, "token-files")
    write(docs, path, **options)
    return read_documents(docs.sparkSession, path)
