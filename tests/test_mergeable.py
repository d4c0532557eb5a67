import datetime as dt

from pyspark.sql import functions as F

from aerolith.operators import sketches
from aerolith.sinks.buckets import join_bucketed, store_bucketed

T0 = dt.datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketches_of_hours_make_those_of_days(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 4 != 0, "a").alias("region"), (F.col("id") % 3000).alias("station"), (F.col("id") % 997).cast("double").alias("v"),
        F.expr("timestampadd(MINUTE, CAST(id % 2880 AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("timestamp"),
    )
    states = sketches.hour_sketches(rows, "station", "v")
    found = sketches.estimates(sketches.merged(states, "station", "v", "month"), "station", "v", (0.1, 0.5)).collect()
    exact = {r.region: r for r in rows.groupBy("region").agg(F.count_distinct("station").alias("s"), F.count("v").alias("n")).collect()}
    assert len(found) == 2
    for r in found:
        assert r.n == exact[r.region].n
        assert abs(r.distinct_station / exact[r.region].s - 1) < 4 * sketches.DISTINCT_ERROR
        assert abs(r.v_q50 / 997 - 0.5) < 2 * sketches.RANK_ERROR and abs(r.v_q10 / 997 - 0.1) < 2 * sketches.RANK_ERROR


def test_sketches_without_values(spark):
    rows = spark.createDataFrame([("a", T0, None, None)], "region string, timestamp timestamp_ntz, station long, v double")
    found = sketches.estimates(sketches.hour_sketches(rows, "station", "v"), "station", "v").collect()
    assert [(r.n, r.distinct_station, r.v_q50) for r in found] == [(0, 0, None)]
    assert sketches.estimates(sketches.hour_sketches(rows.limit(0), "station", "v"), "station", "v").count() == 0


def test_totals_scan_once_and_tell_null_keys_from_totals(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), (None, 1, 5.0)], "region string, day int, v double").write.parquet(path)
    out = sketches.totals(spark.read.parquet(path), ["region", "day"], "v")
    assert plan(out).count("FileScan") == 1 and plan(out).count("Exchange hash") == 1
    rows = {(r.region, r.day, r.level): (r.n, r.v_mean) for r in out.collect()}
    assert rows[(None, None, 3)] == (3, 3.0) and rows[(None, None, 1)] == (1, 5.0) and rows[("a", None, 1)] == (2, 2.0)
    assert rows[(None, 1, 2)] == (2, 3.0) and rows[(None, 1, 0)] == (1, 5.0) and len(rows) == 8


def test_bucketed_tables_join_without_exchange_or_sort(spark):
    base = spark.range(300).select(F.concat(F.lit("r"), F.col("id") % 5).alias("region"), F.col("id").alias("timestamp"), F.rand(1).alias("v"))
    tables = [store_bucketed(base.withColumnRenamed("v", f"v{i}"), ["region", "timestamp"], 4) for i in range(4)]
    out = join_bucketed(*tables, on=["region", "timestamp"])
    assert "Exchange" not in plan(out) and out.count() == 300 and out.columns == ["region", "timestamp", "v0", "v1", "v2", "v3"]
    assert plan(out).count("SortMergeJoin") == 3
