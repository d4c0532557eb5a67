"""Whitening of embeddings on their leading principal components.

The leading eigenvectors of the covariance come from Chebyshev-filtered subspace iteration.
The covariance itself is never formed: each pass over the centred rows X multiplies a narrow
block Q, X'(XQ), in the tasks, and Spark sums the products by dimension.  A polynomial
recurrence of such passes damps what lies below the block's smallest Ritz value; QR and a
Rayleigh-Ritz step follow, until the residuals certify the wanted eigenpairs.  If the block
gains too little (there are eigenvalues beyond it about as large), it is widened, at most to
all dimensions, where the Rayleigh-Ritz step alone is exact.

Entries c count as x = floor(scale * c) + shift.  Sums of x are exact integers, and rows are
centred before they are multiplied.

Vectors that are null or empty, hold null or non-finite entries (or entries that scaled reach
2**40) or have another length than the commonest (the smaller of equally common ones) are left
out.  Repeated ids and rows are vectors of their own; a null id stays null.  Only the id and
the vector are read.  Directions without spread have no component: of equal vectors, of one
vector and of an empty table there is none, and the result is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import stored

#: Vectors of a stored block.
_ROWS = 2048
_LARGEST = 1 << 40
#: Sums of integers are kept as two parts of so many bits below, each far from overflow.
_LOW = 20
#: Values in a row of a matrix on its way to the driver.
_WIDTH = 32
BLOCK = "ids array<long>, x binary, wide boolean, n int"
RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass(frozen=True)
class Components:
    """A fit: the number of vectors, their exact sums, unit eigenvectors (columns) by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    passes: int
    residual: float  # largest ||Vu - eu|| over the largest eigenvalue

    def origin(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(base, rest, offset): the sums are n * base + rest, whole numbers; the means are base + offset."""
        base = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        rest = [s - self.n * b for s, b in zip(self.sums, base, strict=True)]
        return np.array(base, np.int64), np.array(rest, np.int64), np.array([r / self.n for r in rest])


def usable(vectors: DataFrame, vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """Rows whose vector takes part."""
    fits = f"forall(`{vector}`, e -> e IS NOT NULL AND abs(cast(e AS double) * {scale}) < {_LARGEST}D)"
    rows = vectors.where(F.expr(f"size(`{vector}`) > 0 AND {fits}"))
    lengths = rows.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n"))
    commonest = lengths.orderBy(F.col("n").desc(), "length").limit(1).collect()
    return rows.where(F.size(vector) == (commonest[0].length if commonest else 0))


def blocks(rows: DataFrame, key: str, vector: str, scale: int, shift: int) -> DataFrame:
    """The usable rows as blocks of whole numbers: written once, read by each pass."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                entries = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.floor(scale * entries).astype(np.int64) + shift
                wide = bool((abs(x) >= 1 << 31).any())
                data = x.tobytes() if wide else x.astype(np.int32).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([data], pa.binary()),
                        pa.array([wide]), pa.array([part.num_rows], pa.int32()),
                    ],
                    ["ids", "x", "wide", "n"],
                )

    packed = rows.select(F.col(key).cast("long").alias("id"), vector).mapInArrow(pack, BLOCK)
    return stored(packed, "whitening-blocks")


def _read(data: pa.Scalar, wide: pa.Scalar, n: pa.Scalar) -> np.ndarray:
    x = np.frombuffer(data.as_py(), np.int64 if wide.as_py() else np.int32)
    return x.reshape(n.as_py(), -1).astype(np.int64)


def _summed(packed: DataFrame, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind: str = "double") -> np.ndarray:
    """The sum over all blocks of the matrix ``of(x)``: each task sums its own, Spark sums the tasks' by row.

    ``shape`` doesn't grow with the vectors; so many numbers reach the driver.
    """
    dtype = np.float64 if kind == "double" else np.int64
    parts = -(-shape[1] // _WIDTH)
    names = [f"v{k}" for k in range(min(_WIDTH, shape[1]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((shape[0], parts * len(names)), dtype)
        for batch in batches:
            for block in zip(*batch.columns, strict=True):
                total[:, : shape[1]] += of(_read(*block))
        flat = total.reshape(-1, len(names))
        columns = [pa.array(np.arange(len(flat)), pa.int64())] + [pa.array(flat[:, k]) for k in range(len(names))]
        yield pa.RecordBatch.from_arrays(columns, ["at", *names])

    kinds = ", ".join(["at long", *(f"{name} {kind}" for name in names)])
    made = packed.select("x", "wide", "n").mapInArrow(run, kinds)
    out = np.zeros((shape[0] * parts, len(names)), dtype)
    for row in made.groupBy("at").agg(*[F.sum(name).alias(name) for name in names]).collect():
        out[row["at"]] = row[1:]
    return out.reshape(shape[0], -1)[:, : shape[1]]


def _orthonormal(columns: np.ndarray) -> np.ndarray:
    return np.linalg.qr(columns)[0]


def fit(packed: DataFrame, most: int = 8, degree: int = 10, tolerance: float = 1e-13, seed: int = 42) -> Components | None:
    """The leading ``most`` eigenpairs of the blocks' covariance (divisor n); None without vectors."""
    head = packed.agg(F.sum("n").alias("n"), F.max(F.length("x") / F.when(F.col("wide"), 8).otherwise(4) / F.col("n")).alias("d")).first()
    if not head.n:
        return None
    n, d = head.n, int(head.d)

    def halves(x: np.ndarray) -> np.ndarray:
        return np.stack([(x >> _LOW).sum(0), (x & ((1 << _LOW) - 1)).sum(0)], axis=1)

    sums = tuple((int(high) << _LOW) + int(low) for high, low in _summed(packed, halves, (d, 2), "long"))
    origin = Components(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0, 0, 0.0).origin()
    base, _, offset = origin
    passes = 0

    def multiply(q: np.ndarray) -> np.ndarray:
        """The covariance times ``q``; the last column holds the variances."""
        nonlocal passes
        passes += 1

        def product(x: np.ndarray) -> np.ndarray:
            centred = (x - base) - offset
            return np.column_stack([centred.T @ (centred @ q), np.square(centred).sum(0)])

        return _summed(packed, product, (d, q.shape[1] + 1)) / n

    random = np.random.default_rng(seed)
    width = min(d, max(24, 3 * most))
    q = _orthonormal(random.standard_normal((d, width)))
    before = np.inf
    while True:
        product = multiply(q)
        trace, vq = float(product[:, -1].sum()), product[:, :-1]
        inside = q.T @ vq
        ritz, turn = np.linalg.eigh((inside + inside.T) / 2)
        order = np.argsort(-ritz, kind="stable")
        ritz, q, vq = ritz[order], q @ turn[:, order], vq @ turn[:, order]
        top, wanted = max(ritz[0], 0.0), min(most, d)
        gaps = np.linalg.norm(vq - q * ritz, axis=0)[:wanted]
        residual = float(gaps.max() / top) if top > 0 else 0.0
        if residual <= tolerance or width == d:
            break
        if residual > 0.1 * before:
            width = min(d, 2 * width)
            q = _orthonormal(np.column_stack([q, random.standard_normal((d, width - q.shape[1]))]))
            before = np.inf
            continue
        before = residual
        # The interval to damp reaches from 0 to the block's smallest Ritz value; the largest stays of size one.
        half = max(ritz[-1], 1e-12 * top) / 2
        scale = half / (top - half)
        first, last, now = scale, q, (vq - half * q) * (scale / half)
        for _ in range(degree - 1):
            following = 1 / (2 / first - scale)
            now, last = 2 * following / half * (multiply(now)[:, :-1] - half * now) - scale * following * last, now
            scale = following
        q = _orthonormal(now)

    there = ritz[:wanted] > 1e-12 * max(trace, 1e-300)
    keep = np.nonzero(there)[0]
    return Components(n, sums, q[:, keep], ritz[keep], trace, passes, residual)


def identity_error(packed: DataFrame, found: Components) -> float:
    """The largest absolute entry of the whitened vectors' covariance (divisor n, centred) minus the identity."""
    base, _, offset = found.origin()
    turn, k = found.vectors / np.sqrt(found.values), len(found.values)

    def totals(x: np.ndarray) -> np.ndarray:
        return (((x - base) - offset) @ turn).sum(0)[:, None]

    mean = _summed(packed, totals, (k, 1))[:, 0] / found.n

    def products(x: np.ndarray) -> np.ndarray:
        centred = ((x - base) - offset) @ turn - mean
        return centred.T @ centred

    return float(abs(_summed(packed, products, (k, k)) / found.n - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """sum((n * x - S) ** 2) of each row, ``x`` and ``rest`` relative to the base; null beyond a long."""
    largest = n * int(abs(x).max(initial=0)) + int(abs(rest).max(initial=0))
    if x.shape[1] * largest**2 < 1 << 63:
        return np.square(n * x - rest).sum(1).tolist()
    exact = (n * x.astype(object) - rest.astype(object)) ** 2
    return [int(s) if s < 1 << 63 else None for s in exact.sum(1)]


def project(packed: DataFrame, found: Components, error: float) -> DataFrame:
    """id, component, n, deviation, whitened, explained, identity_error: a row per vector and component."""
    base, rest, offset = found.origin()
    turn, k, n = found.vectors / np.sqrt(found.values), len(found.values), found.n
    explained = found.values / found.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, *block in zip(*batch.columns, strict=True):
                x = _read(*block) - base
                white, rows = (x - offset) @ turn, len(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                        pa.array(np.full(rows * k, n), pa.int64()),
                        pa.array(_deviations(x, n, rest), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                        pa.array(white.ravel()),
                        pa.array(np.tile(explained, rows)),
                        pa.array(np.full(rows * k, error)),
                    ],
                    [column.split()[0] for column in RESULT.split(", ")],
                )

    return packed.select("ids", "x", "wide", "n").mapInArrow(run, RESULT)


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 8, scale: int = 1024, shift: int = 100_000
) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is the exact sum over dimensions of (n * x - S) ** 2, null if it exceeds a long; ``whitened``
    the centred vector's projection on the component over the root of its eigenvalue; ``explained`` the
    eigenvalue's share of the trace; ``identity_error`` one value for all rows, see ``identity_error``.
    """
    packed = blocks(usable(vectors, vector, scale), key, vector, scale, shift)
    found = fit(packed, most)
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], RESULT).withColumnRenamed("id", key)
    return project(packed, found, identity_error(packed, found)).withColumnRenamed("id", key)
