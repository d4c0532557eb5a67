import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import queries, whitening


def table_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(vectors, most=8):
    """n, deviations and whitened coordinates by the full covariance, exact where that is asked for."""
    x = np.floor(1024 * np.asarray(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.astype(object).sum(0)]
    deviations = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = x - np.array([s / n for s in sums])
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    keep = [k for k in range(min(most, len(values))) if values[k] > 1e-12 * values.sum()]
    return n, deviations, centred @ turn[:, keep] / np.sqrt(values[keep]), values[keep] / values.sum()


def compare(df, vectors, ids=None, near=1e-7):
    n, deviations, white, explained = brute(vectors)
    ids = list(range(len(vectors))) if ids is None else ids
    rows = df.collect()
    assert len(rows) == white.size and {r.n for r in rows} == {n}
    found = {(r.vec_id, r.component): r for r in rows}
    errors = {r.identity_error for r in rows}
    assert len(errors) == 1 and errors.pop() <= 1e-8
    for k in range(white.shape[1]):
        mine = np.array([found[i, k + 1].whitened for i in ids])
        assert min(abs(mine - white[:, k]).max(), abs(mine + white[:, k]).max()) < near
        assert all(abs(found[i, k + 1].explained / explained[k] - 1) < 1e-9 for i in ids)
        assert [found[i, k + 1].deviation for i in ids] == deviations


@pytest.mark.parametrize("shape", [(40, 3), (300, 12), (900, 60)])
def test_against_the_full_covariance(spark, shape):
    random = np.random.default_rng(shape[1])
    vectors = random.standard_normal(shape) * np.linspace(1, 0.1, shape[1]) @ random.standard_normal((shape[1], shape[1]))
    compare(whitening.whiten(table_of(spark, vectors).repartition(5)), vectors)


def test_a_flat_spectrum_widens_the_block(spark):
    """Beyond the block eigenvalues are as large as inside, so that a narrow one can't be certified."""
    signs = np.random.default_rng(2).choice([-1.0, 1.0], (4000, 64)) * np.linspace(1, 0.98, 64)
    packed = whitening.blocks(whitening.usable(table_of(spark, signs)), "vec_id", "embedding", 1024, 100_000)
    found = whitening.fit(packed, tolerance=1e-13)
    x = np.floor(1024 * signs)
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert np.allclose(found.values, values[:8], rtol=1e-11) and found.residual < 1e-12


def test_certified_within_few_passes_by_the_filter(spark):
    random = np.random.default_rng(4)
    vectors = random.standard_normal((500, 96)) * 0.9 ** np.arange(96)
    packed = whitening.blocks(whitening.usable(table_of(spark, vectors)), "vec_id", "embedding", 1024, 100_000)
    found = whitening.fit(packed)
    assert 10 < found.passes < 60 and found.residual <= 1e-13 and found.vectors.shape == (96, 8)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(8), atol=1e-12)


def test_vectors_that_take_no_part(spark):
    random = np.random.default_rng(5)
    vectors = random.standard_normal((30, 4)).tolist()
    nan, infinite = float("nan"), float("inf")
    others = [None, [], [1.0, nan, 0, 0], [infinite, 0, 0, 0], [0, 0, -infinite, 0], [None, 1, 2, 3], [1.0, 2.0], [1e300, 0, 0, 0]]
    df = table_of(spark, vectors + others)
    for name in ("component", "n", "ids", "x", "id", "length"):
        df = df.withColumn(name, F.lit("clash"))
    compare(whitening.whiten(df), vectors)


def test_repeated_rows_null_ids_and_deviations_beyond_a_long(spark):
    vectors = [[1.0, 2.0], [1.0, 2.0], [3.0, 2.5], [4.0, -1.0]]
    rows = whitening.whiten(table_of(spark, vectors, [5, 5, None, None])).collect()
    assert sorted((r.vec_id or -1, r.component) for r in rows) == [(-1, 1), (-1, 1), (-1, 2), (-1, 2), (5, 1), (5, 1), (5, 2), (5, 2)]
    x = np.array([[3, 1 << 38], [0, -(1 << 38)]], np.int64)
    exact = [(3 * 3 - 1) ** 2 + (3 * (1 << 38) + 2) ** 2, 1 + (-3 * (1 << 38) + 2) ** 2]
    assert whitening._deviations(x, 3, np.array([1, -2])) == [e if e < 1 << 63 else None for e in exact]
    assert whitening._deviations(x >> 20, 3, np.array([1, -2])) == [
        int(sum((3 * int(a) - b) ** 2 for a, b in zip(row, (1, -2)))) for row in x >> 20
    ]


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, []]])
def test_without_spread_there_is_no_component(spark, vectors):
    df = whitening.whiten(table_of(spark, vectors))
    assert df.count() == 0 and df.columns[0] == "vec_id"


def test_fewer_components_than_asked_for(spark):
    line = [[t, 2.0 * t, 0.0] for t in range(20)]
    assert {r.component for r in whitening.whiten(table_of(spark, line)).collect()} == {1}


def test_query_on_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    whole = [r for r in rows if r.embedding is not None and all(e is not None and np.isfinite(e) for e in r.embedding)]
    found = queries.op13_embedding_whitening(spark, "/root/testdata/sf0.01")
    kinds = [f.dataType.simpleString() for f in found.schema.fields]
    assert kinds == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    compare(found, [r.embedding for r in whole], [r.vec_id for r in whole])
