import datetime as dt
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from aerolith.functions.geo import nearest_region
from aerolith.operators import places
from aerolith.operators.time_joins import asof_join, interval_join, overlap_join

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else T0 + dt.timedelta(minutes=minutes)


def made(seed, n, keys="aab", top=400):
    rnd = random.Random(seed)
    return [(i, rnd.choice([*keys, None]), rnd.choice([*range(top), None])) for i in range(n)]


def brute_asof(left, right, tolerance, exact):
    out = []
    for i, key, minute in left:
        hits = [
            (m, j) for j, k, m in right
            if None not in (key, k, minute, m) and k == key and (m <= minute if exact else m < minute)
            and (tolerance is None or m >= minute - tolerance)
        ]
        best = max(hits, default=(None, None))
        out.append((i, best[1], at(best[0])))
    return sorted(out)


@pytest.mark.parametrize("tolerance,exact", [(None, True), (None, False), (30, True), (5, False)])
def test_asof_join(spark, tolerance, exact):
    left, right = made(1, 300), made(2, 120)
    ldf = spark.createDataFrame([(i, k, at(m)) for i, k, m in left], "id int, key string, ts timestamp_ntz")
    rdf = spark.createDataFrame([(i, k, at(m)) for i, k, m in right], "rid int, key string, seen timestamp_ntz")
    out = asof_join(
        ldf, rdf, ["key"], "ts", ["rid"], right_on="seen", tolerance=f"{tolerance} MINUTES" if tolerance else None,
        exact=exact, matched="at",
    )
    assert out.columns == ["id", "key", "ts", "rid", "at"]
    assert sorted(tuple(r) for r in out.select("id", "rid", "at").collect()) == brute_asof(left, right, tolerance, exact)


def test_asof_join_of_a_hot_key_carries_over_the_ranges(spark):
    """One key holds nearly all rows of the left side, and its only matches lie far before most of them."""
    left = spark.range(20_000).select(F.lit("hot").alias("key"), (F.timestamp_seconds(F.col("id") * 60)).alias("ts"), "id")
    right = spark.createDataFrame([("hot", 0, 1), ("hot", 60 * 5000, 2), ("cold", 60, 3)], "key string, s long, v int")
    right = right.select("key", F.timestamp_seconds("s").alias("ts"), "v")
    out = asof_join(left, right, ["key"], "ts", ["v"])
    assert {r.v: r.n for r in out.groupBy("v").agg(F.count("*").alias("n")).collect()} == {1: 5000, 2: 15_000}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_asof_join_of_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", at(5))], "id int, key string, ts timestamp_ntz")
    none = left.limit(0).select("key", "ts", F.col("id").alias("v"))
    assert [r.v for r in asof_join(left, none, ["key"], "ts", ["v"]).collect()] == [None]
    assert asof_join(left.limit(0), none, ["key"], "ts", ["v"]).count() == 0


def spans(seed, n, longest=60):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        start = rnd.choice([*range(400), None])
        length = rnd.choice([0, 1, 2, 7, longest, 390, -3, None])
        rows.append((i, rnd.choice(["a", "a", "b", None]), start, None if None in (start, length) else start + length))
    return rows


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(spark, how):
    moments, intervals = made(3, 250), spans(4, 90)
    mdf = spark.createDataFrame([(i, k, at(m)) for i, k, m in moments], "id int, key string, ts timestamp_ntz")
    idf = spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in intervals], "iid int, key string, start timestamp_ntz, stop timestamp_ntz")
    out = interval_join(mdf, idf, ["key"], "ts", "start", "stop", how)
    assert out.columns == ["id", "key", "ts", "iid", "start", "stop"]
    want = []
    for i, key, m in moments:
        hits = [j for j, k, s, e in intervals if None not in (key, k, m, s, e) and k == key and s <= m < e]
        want += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    assert sorted(map(str, map(tuple, out.select("id", "iid").collect()))) == sorted(map(str, want))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_interval_join_with_none(spark):
    mdf = spark.createDataFrame([(1, "a", at(5))], "id int, key string, ts timestamp_ntz")
    idf = spark.createDataFrame([], "iid int, key string, start timestamp_ntz, stop timestamp_ntz")
    assert interval_join(mdf, idf, ["key"], "ts", "start", "stop").count() == 0
    assert [r.iid for r in interval_join(mdf, idf, ["key"], "ts", "start", "stop", "left").collect()] == [None]


def test_overlap_join(spark):
    left, right = spans(5, 70), spans(6, 70)
    kind = "{0}id int, key string, {0}start timestamp_ntz, {0}stop timestamp_ntz"
    ldf = spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in left], kind.format("l"))
    rdf = spark.createDataFrame([(i, k, at(s), at(e)) for i, k, s, e in right], kind.format("r"))
    out = overlap_join(ldf, rdf, ["key"], ("lstart", "lstop"), ("rstart", "rstop"))
    want = [
        (i, j) for i, k, s, e in left for j, q, t, u in right
        if None not in (k, q, s, e, t, u) and k == q and s < e and t < u and s < u and t < e
    ]
    assert sorted(tuple(r) for r in out.select("lid", "rid").collect()) == sorted(want)


@pytest.mark.parametrize("shape", ["even", "cluster", "line", "one"])
def test_nearest_of_many_equals_the_full_comparison(spark, shape):
    rnd = random.Random(shape)
    spread = {"even": (1.0, 1.0), "cluster": (0.001, 0.001), "line": (0.0, 2.0), "one": (0.0, 0.0)}[shape]
    fixed = [(f"c{i}", 1 + spread[0] * rnd.random(), 103 + spread[1] * rnd.random()) for i in range(1 if shape == "one" else 150)]
    fixed += [(f"again_{n}", lat, lon) for n, lat, lon in fixed[:10]]
    points = [(i, rnd.uniform(0.5, 2.5), rnd.uniform(102, 106)) for i in range(300)]
    points += [(1000 + i, lat, lon) for i, (_, lat, lon) in enumerate(fixed)]  # on a centroid: a tie for the repeated ones
    points += [(5000, None, 103.0), (5001, float("nan"), 103.0), (5002, -80.0, -170.0), (5003, 1e6, 1e6)]
    df = spark.createDataFrame(points, "id int, latitude double, longitude double")
    centroids = spark.createDataFrame([(i, *c) for i, c in enumerate(fixed)], "place int, name string, lat double, lon double")
    got = places.nearest_of_many(df, centroids)
    assert got.columns == ["id", "latitude", "longitude", "region"]
    want = df.select("id", nearest_region(F.col("latitude"), F.col("longitude"), fixed).alias("region"))
    assert {r.id: r.region for r in got.collect()} == {r.id: r.region for r in want.collect()}
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()


def test_nearest_of_many_beyond_all_centroids_takes_no_full_comparison(spark):
    """Most points lie outside the centroids' box, where a ring as wide as their distance holds a large part of all."""
    n, m = 12_000, 40_000
    grid = lambda i, by, top, low, step: low + (i * by) % top * step
    i, j = np.arange(n), np.arange(m)
    fixed = np.stack([grid(i, 7919, 1009, 1.2, 0.00025), grid(i, 104729, 2003, 103.6, 0.00021)], 1)
    points = np.stack([grid(j, 31, 3001, 1.0, 0.0003), grid(j, 17, 4001, 103.3, 0.0003)], 1)
    centroids = spark.createDataFrame(pd.DataFrame({"place": i, "name": i.astype(str), "lat": fixed[:, 0], "lon": fixed[:, 1]}))
    df = spark.createDataFrame(pd.DataFrame({"id": j, "latitude": points[:, 0], "longitude": points[:, 1]}))
    start = time.monotonic()
    got = {r.id: int(r.region) for r in places.nearest_of_many(df, centroids).collect()}
    assert time.monotonic() - start < 90
    assert len(got) == m
    for k in range(0, m, 500):
        at = points[k : k + 500, None, :] - fixed[None]
        want = (at[..., 0] * at[..., 0] + at[..., 1] * at[..., 1]).argmin(1)
        assert [got[x] for x in range(k, k + 500)] == want.tolist()


def test_nearest_without_centroids_or_points(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0)], "id int, latitude double, longitude double")
    none = spark.createDataFrame([(0, "x", None, 1.0)], "place int, name string, lat double, lon double")
    assert [r.region for r in places.nearest_of_many(df, none).collect()] == [None]
    one = spark.createDataFrame([(0, "x", 1.0, 1.0)], "place int, name string, lat double, lon double")
    assert places.nearest_of_many(df.limit(0), one).count() == 0
    assert [r.region for r in places.nearest_of_many(df, one).collect()] == ["x"]
