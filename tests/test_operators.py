import datetime as dt
import random
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.operators import features as f
from aerolith.operators import merge, rollup
from aerolith.operators.blocks import with_row_number
from aerolith.operators.groups import apply_to_groups
from aerolith.operators.joins import first_rows, hindcast, join_series

START = dt.datetime(2024, 1, 1)


def readings(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        station = rng.randrange(6)
        t = START + dt.timedelta(minutes=10 * rng.randrange(600))
        rows.append((f"S{station}", "west" if station < 4 else "east", t, rng.uniform(0, 360), 1.3 + station / 100, 103.7))
    return spark.createDataFrame(
        rows, "station_id string, region string, timestamp timestamp_ntz, x double, latitude double, longitude double"
    )


def series(spark, keys=3, n=90, step=dt.timedelta(days=1), gaps=True, seed=1):
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        length = n * 4 if k == 0 else n  # one dominant key
        for i in range(length):
            if not gaps or rng.random() > 0.15:
                rows.append((f"r{k}", START + i * step, rng.uniform(5, 60)))
    return spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, pm25 double")


def frame(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def assert_same(a, b, *order):
    left, right = frame(a, *order), frame(b, *order)
    pd.testing.assert_frame_equal(left[sorted(left)], right[sorted(right)], check_dtype=False, atol=1e-9)


def test_features_against_pandas(spark):
    df = series(spark)
    got = frame(f.table_features(df, "pm25_daily"), "region", "timestamp")
    parts = []
    for _, g in df.toPandas().sort_values("timestamp").groupby("region"):
        g = g.reset_index(drop=True)
        for lag in (1, 2, 3, 4, 5, 6, 7, 14, 28):
            g[f"pm25_lag_{lag}d"] = g["pm25"].shift(lag)
        for w in (3, 7, 14, 28):
            r = g["pm25"].shift(1).rolling(w, min_periods=max(1, w // 2))
            for stat in ("mean", "std", "min", "max"):
                g[f"pm25_rolling_{stat}_{w}d"] = getattr(r, stat)()
        parts.append(g.dropna())
    want = pd.concat(parts).sort_values(["region", "timestamp"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)], atol=1e-9)


@pytest.mark.parametrize("block_rows", [7, 30, 64])
def test_blocks_equal_plain_windows(spark, block_rows):
    df = series(spark, n=40)
    spec = replace(f.SERIES["pm25_daily"], lags=(1, 3, 28), windows=(3, 14), horizons=(24, 48), target="pm25")
    plain = f.series_features(df, spec, complete=False)
    cut = f.series_features(df, spec, complete=False, block_rows=block_rows)
    assert_same(plain, cut, "region", "timestamp")


def test_unbounded_series_go_through_blocks(spark):
    bounded = f.SERIES["pm25_daily"]
    plan = lambda spec: f.series_features(series(spark, n=5), spec)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" not in plan(bounded)
    assert "_block" in plan(replace(bounded, rows_per_key=None))


def test_one_exchange_for_all_features(spark):
    df = series(spark, n=30)
    executed = f.table_features(f.add_calendar(df, False), "pm25_daily")._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and executed.count("Sort [") == 1


@pytest.mark.parametrize("windows", [(1, 2, 3), (6, 12, 24, 31), (7, 8, 28, 64, 73)])
def test_layered_windows_equal_frames(spark, windows):
    df = series(spark, n=90).withColumn("pm25", F.when(F.rand(3) > 0.2, F.col("pm25")))
    df = spark.createDataFrame(df.toPandas(), df.schema).withColumn("pm25", F.when(~F.isnan("pm25"), F.col("pm25")))
    for needed in ("half", "full", 1):
        spec = replace(f.SERIES["pm25_daily"], windows=windows, min_periods=needed, horizons=(24,), target="pm25")
        layered = replace(spec, layered=True)
        assert_same(
            f.series_features(df, spec, complete=False), f.series_features(df, layered, complete=False), "region", "timestamp"
        )
        blocks = f.series_features(df, layered, complete=False, block_rows=13)
        assert_same(f.series_features(df, spec, complete=False), blocks, "region", "timestamp")


def test_layered_windows_of_a_constant_far_from_zero_have_no_spread(spark):
    rows = [("a", dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), 1e9 + 0.1) for h in range(300)]
    df = spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, pm25 double")
    out = f.series_features(df, replace(f.SERIES["pm25_hourly"], layered=True), complete=False).agg(F.max("pm25_rolling_std_168h"), F.min("pm25_rolling_mean_72h"))
    assert tuple(out.first()) == (pytest.approx(0, abs=1e-6), pytest.approx(1e9 + 0.1, abs=1e-6))


def test_layers_share_one_exchange_and_one_sort_and_are_taken_for_long_windows(spark):
    plan = lambda spec: f.series_features(series(spark, n=30), spec)._jdf.queryExecution().executedPlan().toString()
    spec = f.SERIES["pm25_hourly"]
    assert plan(spec).count("Window [") == 1  # frames for all windows
    for layered in (replace(spec, layered=True), replace(spec, windows=(24, 2000))):
        executed = plan(layered)
        assert executed.count("Exchange hashpartitioning") == 1 and executed.count("Sort [") == 1
    assert plan(replace(spec, layered=True)).count("Window [lag") == 3
    assert plan(replace(spec, windows=(24, 2000))).count("Window [lag") == 4


def test_row_numbers(spark):
    df = series(spark, n=50, step=dt.timedelta(minutes=7))
    got = with_row_number(df, ["region"], "timestamp").toPandas()
    for _, g in got.groupby("region"):
        assert list(g.sort_values("timestamp")["_row"]) == list(range(len(g)))


def test_row_numbers_of_a_hot_key_null_keys_and_none(spark):
    """One key with nearly all rows fills several ranges; nulls are a key like any other."""
    df = spark.range(20_000).select(
        F.when(F.col("id") % 50 != 0, "hot").when(F.col("id") % 100 != 0, "cold").alias("region"),
        F.timestamp_seconds(F.col("id") * 37 % 20_011).alias("timestamp"),
    )
    got = with_row_number(df, ["region"], "timestamp")
    assert got.columns == ["region", "timestamp", "_row"] and got.count() == 20_000
    want = df.withColumn("_want", F.row_number().over(Window.partitionBy("region").orderBy("timestamp")) - 1)
    same = got.join(want, F.col("_row") == F.col("_want"))
    same = same.where(got.region.eqNullSafe(want.region) & (got.timestamp == want.timestamp))
    assert same.count() == 20_000
    assert with_row_number(df.limit(0), ["region"], "timestamp").count() == 0


def test_blocks_read_once_and_exchange_twice(spark):
    """After the one exchange by ranges, which is written, only the blocks are dealt anew."""
    spec = replace(f.SERIES["pm25_hourly"], rows_per_key=None)
    executed = f.series_features(series(spark, n=40), spec, block_rows=50)._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and executed.count("Exchange rangepartitioning") == 0
    assert executed.count("FileScan") == 2 and "BroadcastHashJoin" in executed  # the numbered rows, and the ranges' offsets


def test_rolling_guard(spark):
    spec = replace(f.SERIES["pm25_daily"], lags=(), windows=(7,), rolled=(("pm25", "pm25", ("mean",)),))
    df = series(spark, keys=1, n=1, gaps=False).orderBy("timestamp")
    got = frame(f.series_features(df, spec, complete=False), "timestamp")["pm25_rolling_mean_7d"]
    assert got[:3].isna().all() and got[3] == pytest.approx(df.toPandas()["pm25"][:3].mean())


def test_time_range_features(spark):
    days = [0, 1, 2, 3, 4, 6, 7]  # day 5 is missing
    df = spark.createDataFrame([("r", START + dt.timedelta(days=d), float(d)) for d in days], "region string, timestamp timestamp_ntz, pm25 double")
    for block_days in (3, 512):
        got = frame(f.time_range_features(df, lags=(1, 3), windows=(3,), block_days=block_days), "timestamp").set_index("pm25")
        assert pd.isna(got.loc[6.0, "pm25_lag_1d"]) and got.loc[6.0, "pm25_lag_3d"] == 3
        assert got.loc[3.0, "pm25_rolling_mean_3d"] == 1.5  # days 1 and 2 only
        assert got.loc[7.0, "pm25_rolling_mean_3d"] == 6.0
    gone = f.missing_days(df, ["region"]).collect()
    assert [(r["region"], r["day"]) for r in gone] == [("r", dt.date(2024, 1, 6))]


def test_sensor_features(spark):
    df = spark.createDataFrame(
        [(s, dt.date(2024, 1, d), float(10 * s + d)) for s in (1, 2) for d in range(1, 6)], "sensor_id int, date date, pm25 double"
    )
    got = frame(f.sensor_features(df), "sensor_id", "date")
    first = got[got["date"] == dt.date(2024, 1, 1)]
    assert first["pm_roll_mean_3"].isna().all() and (first["pm_roll_std_3"] == 0).all()
    last = got.iloc[-1]
    assert last["pm_lag_1"] == 24 and last["pm_roll_mean_3"] == 23 and last["dayofweek"] == 4


def test_states_merge_to_days(spark):
    r = readings(spark)
    for circular, direct in ((False, rollup.region_day_scalar), (True, rollup.region_day_circular)):
        states = rollup.hour_states(r, "x", circular=circular)
        assert_same(rollup.days_from_states(states, "x", circular), direct(r, "x"), "region", "timestamp")
        hours = rollup.region_hour_circular(r, "x") if circular else rollup.region_hour_scalar(r, "x")
        assert_same(rollup.hours_from_states(states, "x", circular), hours, "region", "timestamp")


def test_rollups_hash_aggregate(spark):
    r = readings(spark, 20)
    for df in (rollup.region_day_scalar(r, "x"), rollup.region_hour_circular(r, "x"), rollup.hour_states(r, "x")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_first_coordinates_are_one_row(spark):
    t = START + dt.timedelta(hours=1)
    rows = [("a", "w", t, 1.0, 1.0, 10.0), ("b", "w", t, 2.0, 2.0, 20.0), ("c", "w", t - dt.timedelta(minutes=-5), 3.0, None, None)]
    df = spark.createDataFrame(rows, "station_id string, region string, timestamp timestamp_ntz, x double, latitude double, longitude double")
    got = {tuple(r) for n in (1, 3) for r in rollup.region_day_scalar(df.repartition(n), "x").select("latitude", "longitude").collect()}
    assert got in ({(1.0, 10.0)}, {(2.0, 20.0)})


def test_single_reading_day(spark):
    df = readings(spark, 1)
    assert rollup.region_day_scalar(df, "x").first()["x_avg_std"] is None
    assert rollup.days_from_states(rollup.hour_states(df, "x"), "x").first()["x_avg_std"] is None


def test_daily_index_rounds_half_even(spark):
    rows = [("r", START, 0.0), ("r", START, 1.0), ("r", START, 1.0), ("r", START, 0.0)]  # index 0, 4, 4, 0 -> 2
    df = spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, pm25 double")
    assert rollup.daily_index(df).first()["pm25"] == 2.0
    halves = spark.createDataFrame([("r", START, 12.0), ("r", START, 36.0)], df.schema)  # 50, 101 -> 75.5 -> 76
    assert rollup.daily_index(halves).first()["pm25"] == 76.0
    halves = spark.createDataFrame([("r", START, 12.0), ("r", START, 35.0)], df.schema)  # 50, 99 -> 74.5 -> 74
    assert rollup.daily_index(halves).first()["pm25"] == 74.0


def test_most_frequent_tie(spark):
    df = spark.createDataFrame([("c", v) for v in (2, 1, 2, 1, 3)], "city string, v int")
    assert rollup.most_frequent(df, ["city"], "v", "m").first()["m"] == 1


def test_history_modes(spark):
    cols = "region string, timestamp timestamp_ntz, pm25 double"
    fresh = spark.createDataFrame([("r", START, 1.0)], cols)
    stored = spark.createDataFrame([("r", START, 2.0), ("r", START, 1.0), ("q", START, 3.0)], cols)
    by_key = {tuple(r) for r in merge.union_history(fresh, stored.filter("pm25 > 1")).select("region", "pm25").collect()}
    assert by_key == {("r", 1.0), ("q", 3.0)}
    assert merge.union_history(fresh, stored, mode="row").count() == 3
    with pytest.raises(ValueError):
        merge.union_history(fresh, stored, mode="other")


def test_joins(spark):
    s = series(spark, n=10, gaps=False)
    other = s.select("region", "timestamp", F.lit(1).alias("pm25"), (F.col("pm25") * 2).alias("speed"))
    joined = join_series(s, other)
    assert joined.columns == ["region", "timestamp", "pm25", "speed"] and joined.count() == s.count()
    top = first_rows(s, 2, numbered_as="n")
    assert top.groupBy("region").count().filter("count <> 2").isEmpty()
    predictions = s.select("region", "timestamp", F.explode(F.array(F.lit(1), F.lit(2))).alias("days_before_forecast_day"), F.col("pm25").alias("predicted_pm25"))
    assert hindcast(predictions, s, "r1").count() == 20


def test_group_function(spark):
    out = apply_to_groups(series(spark, n=5), ["region"], lambda g: g.head(1)[["region", "pm25"]], "region string, pm25 double")
    assert out.count() == 3


def test_hourly_features_compile(spark, capfd):
    """Generated code of long windows stays below the compiler's limits."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", t0 + dt.timedelta(hours=h), float(h % 31)) for h in range(400)]
    df = spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, pm25 double")
    assert f.table_features(f.add_calendar(df, True), "pm25_hourly").count() == 400 - 168 + 84
    assert f.multi_horizon_targets(df).count() == 400 - 168 - 168
    assert "grows beyond 64 KB" not in "".join(capfd.readouterr())
