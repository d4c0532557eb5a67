"""Best-fit packing with matching of large items.

Pieces above a third of the capacity share a sequence with at most one other such piece: in
falling order of length each takes the longest free partner that fits.  Smaller pieces then
go, in falling order, into the smallest gap that holds them, or open new sequences.

Only how many pieces have which length matters for the plan, at most ``capacity`` numbers.
The plan says where the pieces of a length with ranks in some range go; the pieces, numbered
within (task, length), find their rank by the counts of the tasks before.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import stored
from aerolith.llm.tokens import VOCABULARY, encoder

PIECE = "doc_id long, piece int, start long, length long, ids binary, _task int, _nth long"
#: length, first rank, pieces, first sequence, pieces per sequence, offset of the first piece there.
Entry = tuple[int, int, int, int, int, int]


def plan(counts: dict[int, int], capacity: int) -> list[Entry]:
    """Where the pieces go, in runs of equal length."""
    left = {n: c for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    entries: list[Entry] = []
    ranks: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences [first, end)
    sequences = 0

    def place(length: int, pieces: int, first: int, each: int, offset: int) -> None:
        entries.append((length, ranks[length], pieces, first, each, offset))
        ranks[length] += pieces

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        while left.get(n, 0):
            partner = next((m for m in large if m <= n and m + n <= capacity and left.get(m, 0) > (m == n)), None)
            if partner is None:
                pairs = left[n]
                place(n, pairs, sequences, 1, 0)
                used, left[n] = n, 0
            elif partner == n:
                pairs = left[n] // 2
                place(n, 2 * pairs, sequences, 2, 0)
                used, left[n] = 2 * n, left[n] - 2 * pairs
            else:
                pairs = min(left[n], left[partner])
                place(n, pairs, sequences, 1, 0)
                place(partner, pairs, sequences, 1, n)
                used, left[n], left[partner] = n + partner, left[n] - pairs, left[partner] - pairs
            gaps[capacity - used].append((sequences, sequences + pairs))
            sequences += pairs

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        many = left[n]
        for gap in range(n, capacity + 1):
            while many and gaps.get(gap):
                first, end = gaps[gap].pop()
                each = gap // n  # best fit goes on in the sequence that it has begun to fill
                full = min(end - first, many // each)
                if full:
                    place(n, full * each, first, each, capacity - gap)
                    gaps[gap - each * n].append((first, first + full))
                    many -= full * each
                if first + full < end and many:
                    place(n, many, first + full, many, capacity - gap)
                    gaps[gap - many * n].append((first + full, first + full + 1))
                    full, many = full + 1, 0
                if first + full < end:
                    gaps[gap].append((first + full, end))
                    break
            if not many:
                break
        if many:
            each = capacity // n
            full, rest = divmod(many, each)
            if full:
                place(n, full * each, sequences, each, 0)
                gaps[capacity - each * n].append((sequences, sequences + full))
                sequences += full
            if rest:
                place(n, rest, sequences, rest, 0)
                gaps[capacity - rest * n].append((sequences, sequences + 1))
                sequences += 1
    return entries


def cut(docs: DataFrame, capacity: int, vocabulary: str, separator: int, most_words: int) -> DataFrame:
    """The pieces of each document, numbered within (task, length)."""
    end = np.array([separator], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, words = TaskContext.get().partitionId(), encoder(vocabulary, most_words)
        seen = np.zeros(capacity + 1, np.int64)
        names = [column.split()[0] for column in PIECE.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = words.encode(text.as_py()) + end
                total = len(ids) // 4
                start, piece = 0, 0
                length = total % capacity or capacity  # the first piece takes what whole ones leave over
                while start < total:
                    rows.append((doc_id, piece, start, length, ids[4 * start : 4 * (start + length)], task, seen[length]))
                    seen[length] += 1
                    size += length
                    start, piece, length = start + length, piece + 1, capacity
                if size > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select("doc_id", "text").mapInArrow(pieces, PIECE)


def pack(
    docs: DataFrame, capacity: int = 2048, vocabulary: str = VOCABULARY, separator: int = 0, payload: Column | None = None,
    most_words: int = 420_000,
) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset: every document's pieces and their places.

    ``payload``, if given, is a column made of ``ids`` that takes its place; it is computed before pieces
    meet their places, so that a digest is shuffled instead of the ids.

    A document is its ids and the separator; one longer than ``capacity`` is cut into pieces of that
    length, the first piece takes the rest.  Null or empty text is the separator alone.  Repeated rows
    and ids are documents of their own.  An empty table gives no piece.  Other columns are not read.
    """
    pieces = stored(cut(docs, capacity, vocabulary, separator, most_words), "pieces")
    counts = pieces.groupBy("length", "_task").agg(F.count("*").alias("_n"))
    counts = stored(counts, "piece-counts")  # at most ``capacity`` rows a task
    totals = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    entries = sorted(plan({row.length: row.n for row in totals}, capacity))
    runs = [np.array(column, np.int64) for column in zip(*entries)] or [np.zeros(0, np.int64)] * 6

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, first_rank, _, first, each, offset = runs
        if not len(length):
            return pd.DataFrame({"sequence_id": [], "offset": []}, dtype="int64")
        # Entries are sorted by (length, first rank); a combined key finds the run of each piece.
        span = int(max(first_rank.max(), rank.max())) + 1
        at = np.searchsorted(lengths * span + first_rank, length.to_numpy() * span + rank.to_numpy(), "right") - 1
        nth = rank.to_numpy() - first_rank[at]
        return pd.DataFrame(
            {"sequence_id": first[at] + nth // each[at], "offset": offset[at] + nth % each[at] * length.to_numpy()}
        )

    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    if payload is not None:
        pieces = pieces.withColumn("_payload", payload).drop("ids").withColumnRenamed("_payload", "ids")
    # The shifts grow with the tasks, and files of counts are far smaller than the counts: never broadcast.
    ranked = pieces.join(shifts.hint("merge"), ["length", "_task"])
    ranked = ranked.withColumn("_at", placed("length", F.col("_nth") + F.col("_shift")))
    return ranked.select("doc_id", "piece", "start", "length", "ids", "_at.sequence_id", "_at.offset")


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens, ids: the packed sequences themselves; at most ``capacity`` pieces each."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_rows"))
    joined = rows.select("sequence_id", F.expr("aggregate(_rows, X'', (a, r) -> concat(a, r.ids))").alias("ids"))
    return joined.select("sequence_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids")
