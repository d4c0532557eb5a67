"""Approximate nearest neighbours by an adaptive dimension scan of an inverted file.

Vectors are scaled to length one and turned by a random rotation, so that the first d of D
columns estimate a squared distance by D/d times their part.  Lists are the cells of centroids
found by k-means on a bounded sample; every row is indexed.  A query probes its nearest lists.
There candidates are scanned in blocks of columns; after each block those whose estimate lies
beyond the best distances so far by more than the test allows are given up.  Survivors get the
exact cosine of the original vectors in double precision.

Queries come in blocks of bounded size, which are sent to the tasks; the lists stay where they are,
dealt by ranges of (list, id), so that a hot list is work for several tasks.  A task scans its rows in
chunks and hands on k rows a query.  Before the scan each query takes the distance of the k-th nearest
id of the sample within the lists that it probes as a bound; without k of them there it has none.  A
query that ends with fewer than k ids, as the test gave up too many or its lists hold too few, scans all
lists again without giving up any, so that min(k, candidates) are found always.

Vectors that are null, zero, or hold null or non-finite numbers take no part, nor do those whose
number of dimensions isn't the candidates' most frequent one.  Ties go to the smaller id; of repeated
ids the nearest counts, of queries of one id all vectors.  Only the id and the vector are read.
Without queries or candidates there is no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.common import new_path, stored


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    """Rotation, centroids (of rotated vectors of length one) and the sample: ids, vectors, and these rotated."""

    rotation: np.ndarray
    centroids: np.ndarray
    sample_ids: np.ndarray
    originals: np.ndarray
    sample: np.ndarray

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return (unit_rows(x.astype(np.float64)) @ self.rotation).astype(np.float32)

    def lists(self, rotated: np.ndarray, probes: int) -> np.ndarray:
        """The nearest ``probes`` centroids of each row, nearest first."""
        return np.argsort(-(rotated @ self.centroids.T), axis=1, kind="stable")[:, :probes]

    def bounds(self, ids: np.ndarray, x: np.ndarray, lists: np.ndarray, k: int) -> np.ndarray:
        """Squared distance of each row of ``x`` to its ``k``-th nearest other id of the sample within its ``lists``.

        Infinite if there are fewer.  Repeated ids count once, with their nearest vector there.
        """
        own, starts = np.unique(self.sample_ids, return_index=True)  # the sample is sorted by id
        if len(own) < k:
            return np.full(len(ids), np.inf)
        probed = np.zeros((len(ids), len(self.centroids)), bool)
        np.put_along_axis(probed, lists, True, axis=1)
        near = self.rotated(x) @ self.sample.T
        near[~probed[:, self.lists(self.sample, 1)[:, 0]]] = -np.inf
        near = np.maximum.reduceat(near, starts, axis=1)
        near[ids[:, None] == own[None]] = -np.inf
        kth = np.partition(near, len(own) - k, axis=1)[:, len(own) - k]
        return 2 - 2 * kth.astype(np.float64) + 1e-5  # a little more, for single precision


def cosines(x: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (x * query).sum(axis=1) / (np.linalg.norm(x, axis=1) * np.linalg.norm(query))


def _even(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two, which changes no direction and no digit, so that squares neither overflow nor vanish."""
    largest = abs(x).max(axis=1, initial=0)
    if not len(x) or (1e-100 < largest.min() and largest.max() < 1e100):
        return x
    return np.ldexp(x, -np.frexp(largest)[1][:, None])


def _vectors(column: pa.Array) -> np.ndarray:
    return _even(np.array(column.to_pylist(), np.float64).reshape(len(column), -1))


def usable(rows: DataFrame, key: str, vector: str, dimensions: int | None = None) -> DataFrame:
    """id, v (array of double) of the rows that take part; ``dimensions``: the most frequent number by default."""
    v = F.col(vector).cast("array<double>")
    rows = rows.select(F.col(key).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.where(F.exists("v", lambda x: x != 0))
    if dimensions is None:
        size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
        dimensions = size.n if size else 0
    return rows.where(F.size("v") == dimensions)


def fit(rows: DataFrame, lists: int = 64, sample: int = 8192, rounds: int = 8, seed: int = 5) -> Index | None:
    """k-means on about ``sample`` vectors, chosen by a hash of the id; None without vectors."""
    total = rows.count()
    scale = 1 << 30
    share = int(min(1.0, sample / total) * scale) + (total <= sample) if total else 0
    found = rows.where(F.pmod(F.xxhash64("id"), F.lit(scale)) < share).toArrow()
    if not found.num_rows:
        found = rows.orderBy("id").limit(1).toArrow()
        if not found.num_rows:
            return None
    order = np.argsort(found.column("id").to_numpy(), kind="stable")
    ids = found.column("id").to_numpy()[order]
    originals = _even(np.array(found.column("v").to_pylist(), np.float64)[order])
    rng = np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(originals.shape[1],) * 2))[0]
    x = (unit_rows(originals) @ rotation).astype(np.float32)
    distinct = np.unique(x, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(lists, len(distinct)), replace=False)]
    for _ in range(rounds):
        nearest = (distinct @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, distinct)
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(lengths > 0, sums / np.maximum(lengths, 1e-12), centroids)
    return Index(rotation, centroids.astype(np.float32), ids, originals, x)


def scan_chunk(
    query: np.ndarray, bound: float, columns: list[np.ndarray], ids: np.ndarray, own: int, k: int, epsilon: float
) -> np.ndarray:
    """Rows of a chunk that survive the scan for one rotated query of id ``own``; ``columns``: the chunk's blocks of columns.

    ``ids``, the rows' ids, are sorted.  Rows of the query's own id don't take part, and of the ``k`` nearest each id is one.
    """
    total = sum(c.shape[1] for c in columns)
    low, high = np.searchsorted(ids, own), np.searchsorted(ids, own, side="right")
    alive, partial, seen = None, None, 0
    if low < high:
        alive = np.concatenate([np.arange(low), np.arange(high, len(ids))])
        if not len(alive):
            return alive
    for block in columns:
        part = query[seen : seen + block.shape[1]]
        rows = block if alive is None else block[alive]
        d = ((rows - part) ** 2).sum(axis=1)
        partial = d if partial is None else partial + d
        seen += block.shape[1]
        if seen == total:
            break
        # Reject "the distance is within the bound" when the estimate lies too far beyond it.
        keep = partial * (total / seen) <= bound * (1 + epsilon / np.sqrt(seen)) ** 2
        alive = np.flatnonzero(keep) if alive is None else alive[keep]
        partial = partial[keep]
        if not len(alive):
            return alive
    alive = np.arange(len(partial)) if alive is None else alive
    limit = bound
    if len(alive) > k:
        found = ids[alive]
        nearest = np.minimum.reduceat(partial, np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])))
        if len(nearest) > k:
            limit = min(limit, float(np.partition(nearest, k - 1)[k - 1]) + 1e-5)
    return alive[partial <= limit + 1e-5]


@dataclass(frozen=True)
class Block:
    """Some queries: ids, vectors, bounds, and which lists (columns) each probes."""

    ids: np.ndarray
    x: np.ndarray
    bounds: np.ndarray
    probed: np.ndarray


HIT = "query_id long, vec_id long, score double"


def _scan(index: Index, queries: Block, lists: DataFrame, k: int, chunk: int, block: int, epsilon: float) -> DataFrame:
    """Hits of a block of queries: for each task of the stored lists at most ``k`` rows a query."""
    shared = lists.sparkSession.sparkContext.broadcast((index, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, asked = shared.value
        turned_q, bounds = known.rotated(asked.x), asked.bounds.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                part = batch.slice(start, chunk)
                ids, own = part.column(0).to_numpy(), part.column(2).to_numpy()
                x = _vectors(part.column(1))
                turned = known.rotated(x)
                for number in np.unique(own):
                    rows = np.flatnonzero(own == number)
                    rows = rows[np.argsort(ids[rows], kind="stable")]
                    here, vectors = ids[rows], x[rows]
                    columns = [np.ascontiguousarray(turned[rows, i : i + block]) for i in range(0, turned.shape[1], block)]
                    for q in np.flatnonzero(asked.probed[:, number]):
                        alive = scan_chunk(turned_q[q], bounds[q], columns, here, asked.ids[q], k, epsilon)
                        if not len(alive):
                            continue
                        found, score = here[alive], cosines(vectors[alive], asked.x[q])
                        if q in best:
                            found, score = np.concatenate([best[q][0], found]), np.concatenate([best[q][1], score])
                        order = np.lexsort((found, -score))
                        order = order[np.sort(np.unique(found[order], return_index=True)[1])[:k]]  # the best row of each id
                        best[q] = found[order], score[order]
                        if len(order) == k:  # the k-th nearest of these rows bounds those that follow
                            bounds[q] = min(bounds[q], 2 - 2 * score[order[-1]] + 1e-5)
        for q, (found, score) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), asked.ids[q])), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"]
            )

    return lists.select("id", "v", "list").mapInArrow(run, HIT)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    lists: int = 64, probes: int = 46, chunk: int = 4096, block: int = 16, epsilon: float = 2.1, sample: int = 8192,
    query_block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest cosines found for each row of ``queries`` (same columns as ``vectors``).

    A row is no candidate of a query with its own id.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    index = fit(rows, lists, sample)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = index.lists(index.rotated(_vectors(batch.column(1))), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.int32())], ["id", "v", "list"])

    by_list = rows.mapInArrow(placed, "id long, v array<double>, list int").repartitionByRange("list", "id")
    indexed = stored(by_list.sortWithinPartitions("list", "id"), "ann-lists")
    candidates = indexed.agg(F.count_distinct("id")).first()[0]
    asked = usable(queries, key, vector, index.originals.shape[1])

    def scanned(asked: DataFrame, whole: bool) -> DataFrame:
        """Hits of all queries, block by block; ``whole``: of all lists, and nothing is given up."""
        count = asked.count()
        blocks = -(-count // query_block)
        dealt = stored(asked.withColumn("part", F.floor(F.rand(11) * blocks).cast("int")), "ann-queries")
        path = new_path(spark, "ann-hits")
        spark.createDataFrame([], HIT).write.parquet(path)
        for number in range(blocks):
            found = dealt.where(F.col("part") == number).toArrow()  # about query_block rows
            if found.num_rows:
                ids, x = found.column("id").to_numpy(), _vectors(found.column("v"))
                near = index.lists(index.rotated(x), len(index.centroids) if whole else probes)
                probed = np.zeros((len(ids), len(index.centroids)), bool)
                np.put_along_axis(probed, near, True, axis=1)
                step = range(0, len(ids), 512)
                bounds = [np.full(len(ids[i : i + 512]), np.inf) if whole else index.bounds(ids[i : i + 512], x[i : i + 512], near[i : i + 512], k) for i in step]
                queries_ = Block(ids, x, np.concatenate(bounds), probed)
                _scan(index, queries_, indexed, k, chunk, block, np.inf if whole else epsilon).write.mode("append").parquet(path)
        hits = spark.read.schema(HIT).parquet(path)
        return hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))

    hits = stored(scanned(asked, whole=False), "ann-found")
    own = indexed.select(F.col("id").alias("query_id")).distinct().withColumn("_own", F.lit(1))
    counts = hits.groupBy("query_id").agg(F.count("*").alias("_n"))
    short = asked.select(F.col("id").alias("query_id")).distinct().join(counts, "query_id", "left").join(own, "query_id", "left")
    reachable = F.lit(candidates) - F.coalesce("_own", F.lit(0))
    short = short.where(F.coalesce("_n", F.lit(0)) < F.least(F.lit(k), reachable)).select(F.col("query_id").alias("id"))
    again = stored(asked.join(short, "id", "left_semi"), "ann-short")
    if not again.isEmpty():
        hits = hits.unionByName(scanned(again, whole=True)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
