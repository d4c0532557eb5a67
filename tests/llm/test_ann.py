import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import ann


def brute(rows, queries, k):
    out = {}
    ids, x = [i for i, _ in rows], np.array([v for _, v in rows], np.float64)
    for i, v in queries:
        v = np.array(v, np.float64)
        scores = {}
        for c, s in zip(ids, (x @ v) / (np.linalg.norm(x, axis=1) * np.linalg.norm(v))):
            if c != i:
                scores[c] = max(s, scores.get(c, -2))
        out[i] = sorted(scores.items(), key=lambda t: (-t[1], t[0]))[:k]
    return out


def results(df):
    found = {}
    for r in df.collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in found.items()}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    queries = [r for r in rows if r[0] % 50 == 0]
    expected = brute(rows, queries, 5)
    # Small sample and chunks: lists in several chunks, bounds that don't know the answer.
    found = results(ann.search(df.repartition(3), df.where("vec_id % 50 = 0"), sample=300, chunk=40, lists=16, probes=12))
    assert set(found) == set(expected)
    hits = 0
    for q, best in found.items():
        assert [r for r, _, _ in best] == [1, 2, 3, 4, 5]
        assert [(i, s) for _, i, s in best] == sorted([(i, s) for _, i, s in best], key=lambda t: (-round(t[1], 12), t[0]))
        hits += len({i for _, i, _ in best} & {i for i, _ in expected[q]})
        exact = {i: s for i, s in brute(rows, [r for r in queries if r[0] == q], len(rows))[q]} if hits < 20 else {}
        assert all(abs(exact[i] - s) < 1e-12 for _, i, s in best if exact)
    assert hits / (5 * len(expected)) >= 0.9


def test_odd_vectors_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
        (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (10, []), (11, [1.0, 1.0]), (11, [1.0, 0.5]), (None, [1.0, 0.0]),
        (50, [0.0, 2.0]),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<float>, score string, list int")
    good = [(i, v) for i, v in rows if i in (0, 1, 2, 3, 11, 50)]
    for k in (2, 5, 9):
        found = results(ann.search(df, df.where("vec_id % 50 = 0"), k=k))
        expected = brute(good, [r for r in good if r[0] in (0, 50)], k)
        assert {q: [i for _, i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in expected.items()}
    assert ann.search(df.limit(0), df).collect() == []
    assert ann.search(df, df.limit(0)).collect() == []


def test_many_equal_vectors(spark):
    """A third of all rows are one vector; ties go to the smallest ids."""
    rng = np.random.default_rng(1)
    rows = [(i, [1.0] * 8 if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = results(ann.search(df.repartition(4), df.where("vec_id % 50 = 0"), sample=200, chunk=50))
    for q, best in found.items():
        if q % 3 == 0:
            assert [i for _, i, _ in best] == [i for i in range(0, 900, 3) if i != q][:5]
            assert all(abs(s - 1) < 1e-12 for _, _, s in best)
    assert df.where(F.col("vec_id") % 50 == 0).count() == len(found)


def test_recall_with_production_parameters(spark):
    """Given tables, and one larger than the sample: lists, probes and epsilon are those of the query."""
    rng = np.random.default_rng(3)
    given = {sf: spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet") for sf in ("sf0.01", "sf0.1")}
    base = np.array([r.embedding for r in given["sf0.1"].collect()])
    x = base[rng.integers(0, len(base), 12_000)] + rng.normal(size=(12_000, base.shape[1])) * base.std()
    large = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    for name, df in {**given, "large": large}.items():
        rows = [(r.vec_id, r.embedding) for r in df.collect()]
        queries = [r for r in rows if r[0] % (50 if name != "large" else 400) == 0]
        asked = df.where(F.col("vec_id").isin([i for i, _ in queries]))
        expected, found = brute(rows, queries, 5), results(ann.search(df, asked))
        hits = sum(len({i for _, i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
        assert {q: len(v) for q, v in found.items()} == {q: 5 for q in expected}, name
        assert hits / (5 * len(expected)) >= 0.9, name


def test_results_come_from_the_probed_lists_while_they_suffice(spark):
    """One of many lists probed: rows of the other lists, all of them in the sample, come in only where k aren't there."""
    rng = np.random.default_rng(4)
    centres = np.eye(8) * 10
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.1).tolist()) for i in range(32)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for k in (1, 3, 9, 50):
        found = results(ann.search(df, df.where("vec_id = 0"), k=k, lists=8, probes=1))
        assert [i for _, i, _ in found[0]] == [i for i, _ in brute(rows, rows[:1], k)[0]] and len(found[0]) == min(k, 31)


def test_queries_in_blocks_of_other_dimensions_and_sizes(spark):
    """Most queries have two numbers, the vectors three; components near the ends of the range of a double."""
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(120)]
    rows += [(200, [1e300, 2e300, -1e300]), (201, [1e-300, 3e-300, 0.0]), (202, [1e300, 1e-300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    flat = spark.createDataFrame([(1000 + i, [1.0, 2.0]) for i in range(300)], df.schema)
    asked = df.where("vec_id % 10 = 0 or vec_id > 200").unionByName(flat)
    found = results(ann.search(df, asked, lists=4, probes=3, query_block=4, chunk=16))
    scaled = [(i, (np.array(v) / np.abs(v).max()).tolist()) for i, v in rows]
    expected = brute(scaled, [r for r in scaled if r[0] % 10 == 0 or r[0] > 200], 5)
    assert set(found) == set(expected) and all(len(v) == 5 and np.isfinite([s for _, _, s in v]).all() for v in found.values())
    hits = sum(len({i for _, i, _ in found[q]} & {i for i, _ in expected[q]}) for q in expected)
    assert hits / (5 * len(expected)) >= 0.9


def test_repeated_ids_take_no_places(spark):
    """The nearest id six times, the query's own id five times: k other ids are found all the same."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    rows += [(i, (np.array(v) + 1e-4 * rng.normal(size=16)).tolist()) for i, v in rows[:1] for _ in range(5)]
    near = (np.array(rows[0][1]) + 0.01).tolist()
    rows += [(1000, near)] * 6 + [(1001, (np.array(near) + 0.02).tolist())] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one = spark.createDataFrame(rows[:1], df.schema)
    for settings in ({"lists": 1, "probes": 1}, {"lists": 4, "probes": 4, "chunk": 50}, {"lists": 1, "probes": 1, "sample": 20}):
        found = results(ann.search(df, one, epsilon=50.0, **settings))
        assert [i for _, i, _ in found[0]] == [i for i, _ in brute(rows, rows[:1], 5)[0]], settings
