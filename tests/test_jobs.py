import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators.features import SERIES, add_calendar, table_features
from aerolith.operators.forecast import forecast_regions, forecast_state, linear_scorer, recursive_forecast
from aerolith.operators.model import TreeParams, evaluate, feature_importance, features_of, fit, score
from aerolith.operators.rollup import region_hour_scalar
from aerolith.plans import backfill, ingest, predict, train
from aerolith.registry import stored
from aerolith.schemas import FEATURE_TABLES, TableSpec
from aerolith.session import materialize
from aerolith.sinks.tables import create_table
from aerolith.sources.tables import read_table
from aerolith.streaming.ingest import keep_readings, stream_station_readings
from aerolith.streaming.rollup import hourly_windows, keep_table_current

DAY = dt.timedelta(days=1)
TREES = TreeParams(rounds=4, learning_rate=0.3, max_depth=3, min_rows_per_leaf=1, row_fraction=1.0, column_fraction=1.0)


def landed(folder, days, first=dt.date(2024, 1, 1), seed=5):
    """Landing files of some days: 4 readings per day of PM2.5 and of three weather measures."""
    rng = random.Random(seed)
    stations = [
        {"id": f"S{i}", "deviceId": f"S{i}", "name": f"n{i}", "location": {"latitude": lat, "longitude": lon}}
        for i, (lat, lon) in enumerate([(1.42, 103.83), (1.35, 103.93)])
    ]
    for d in range(days):
        day = first + d * DAY
        times = [f"{day}T{h:02d}:10:00+08:00" for h in (1, 7, 13, 19)]
        items = [
            {"date": str(day), "timestamp": t, "updatedTimestamp": t,
             "readings": {"pm25_one_hourly": {"north": rng.randint(5, 40), "east": rng.randint(5, 40), "national": 1}}}
            for t in times
        ]
        write(folder / "pm25" / f"{day}.json", {"code": 0, "data": {"items": items}})
        for measure, top in (("wind_speed", 10), ("wind_direction", 360), ("air_temperature", 35)):
            readings = [
                {"timestamp": t, "data": [{"stationId": f"S{i}", "value": rng.uniform(0, top)} for i in (0, 1, 9)]} for t in times
            ]
            write(folder / measure / f"{day}.json", {"code": 0, "data": {"stations": stations, "readings": readings}})


def write(path, document):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(document))


def test_ingest_train_predict(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "store")
    landed(landing, 75)
    paths = {m: str(landing / m) for m in ("pm25", "wind_speed", "wind_direction", "air_temperature")}
    daily = {m: p for m, p in paths.items()}
    done = ingest.daily_ingest(spark, daily, root)
    assert done["pm25_daily"] and done["wind_direction_daily"] and done["wind_speed_hourly"]
    pm25 = read_table(spark, root, "pm25_daily")
    # 75 days, 28 of them warm-up; unknown station S9 is left out.
    assert {r["region"]: r["count"] for r in pm25.groupBy("region").count().collect()} == {"north": 47, "east": 47}
    assert pm25.agg(F.min("timestamp")).first()[0] == dt.datetime(2024, 1, 29)

    # The same delivery once more changes nothing (history rows meet their own keys).
    before = {tuple(r) for r in pm25.select("region", "timestamp", "pm25_lag_28d").collect()}
    ingest.daily_ingest(spark, {"pm25": paths["pm25"]}, root)
    assert {tuple(r) for r in read_table(spark, root, "pm25_daily").select("region", "timestamp", "pm25_lag_28d").collect()} == before

    metrics = train.train_regions(spark, root, "2024-03-10", ["north", "east"], TREES)
    assert {r["region"]: r["n"] for r in metrics.collect()} == {"north": 6, "east": 6}
    out = predict.predict_and_store(spark, root, dt.datetime(2024, 3, 12), ["north", "east"])
    assert out.groupBy("region").agg(F.max("days_before_forecast_day").alias("m")).filter("m <> 4").isEmpty()
    assert out.count() == 8 and out.filter("predicted_pm25 is null").isEmpty()
    joined = predict.stored_hindcast(spark, root)
    assert joined.count() == 8
    assert predict.hindcast_metrics(joined).count() == 8


def test_forecast_ingest(spark, tmp_path):
    path, root = tmp_path / "f" / "x.json", str(tmp_path / "store")
    start, hours = 1704067200, 24 * 31
    write(path, {"region": "north", "start_s": start, "end_s": start + hours * 3600, "interval_s": 3600,
                 "temperature_2m": [float(h % 24) for h in range(hours)], "wind_speed_10m": [1.0 + h % 5 for h in range(hours)],
                 "wind_direction_10m": [float(h * 7 % 360) for h in range(hours)]})
    ingest.forecast_ingest(spark, str(path), root)
    days = read_table(spark, root, "wind_speed_daily")
    assert days.count() == 3
    hourly = read_table(spark, root, "wind_direction_hourly")
    assert hourly.count() == hours - 168 and hourly.select("wind_direction_std").distinct().count() == 1


def test_backfill_hours_and_days(spark):
    t0 = dt.datetime(2024, 1, 1)
    stations = spark.createDataFrame(
        [(s, t0 + dt.timedelta(hours=h), float(10 * i + h % 24), 1.42, 103.83) for i, s in enumerate("AB") for h in range(48)],
        "station_name string, timestamp timestamp_ntz, wind_direction_avg double, latitude double, longitude double",
    )
    hours = backfill.region_hours(stations, "wind_direction")
    assert hours.count() == 48
    circular = backfill.region_days(stations, "wind_direction").first()
    plain = backfill.region_days(stations, "wind_direction", circular=False).first()
    assert circular["wind_direction_avg_mean"] == pytest.approx(plain["wind_direction_avg_mean"], abs=0.2)
    assert plain["wind_direction_avg_std"] > 1 and plain["latitude"] == 1.42
    tables = backfill.backfill_tables(
        hours.select("region", "timestamp", F.lit(1.0).alias("pm25")), hours.select("region", "timestamp", F.lit(1.0).alias("pm25")),
        {"wind_direction": stations},
    )
    assert set(tables) == {"pm25_hourly", "pm25_daily", "wind_direction_hourly", "wind_direction_daily"}


def history(spark, days=60, regions=("a", "b")):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(r, t0 + d * DAY, 20 + 10 * math.sin(d / 3) + i) for i, r in enumerate(regions) for d in range(days)]
    return spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, pm25 double")


def test_recursion_feeds_predictions_back(spark):
    past = history(spark)
    as_of = dt.datetime(2024, 3, 1)  # day 60
    weather = history(spark, 70).filter(F.col("timestamp") >= F.lit(as_of)).select("region", "timestamp", F.lit(1.0).alias("t"))
    state = forecast_state(past, weather, as_of)
    got = recursive_forecast(state, linear_scorer({"pm25_lag_1d": 0.5, "t": 1.0}), 7).filter("region = 'a'").orderBy("timestamp").collect()
    value = past.filter("region = 'a'").orderBy(F.col("timestamp").desc()).first()["pm25"]
    for k, row in enumerate(got, 1):
        value = 0.5 * value + 1.0
        assert row["days_before_forecast_day"] == k and row["predicted_pm25"] == pytest.approx(value)
    assert len(got) == 7
    stepwise = forecast_regions(state, {r: linear_scorer({"pm25_lag_1d": 0.5, "t": 1.0}) for r in "ab"}, 3)
    chain = recursive_forecast(state, linear_scorer({"pm25_lag_1d": 0.5, "t": 1.0}), 3)
    assert sorted(map(tuple, stepwise.collect())) == sorted(map(tuple, chain.collect()))


def test_window_rules_differ_by_one_day(spark):
    past = history(spark, 30, ("a",))
    as_of = dt.datetime(2024, 1, 31)
    weather = spark.createDataFrame([("a", as_of, 0.0)], "region string, timestamp timestamp_ntz, t double")
    state = forecast_state(past, weather, as_of)
    values = [r["pm25"] for r in past.orderBy("timestamp").collect()]
    full, short = (
        recursive_forecast(state, linear_scorer({"pm25_rolling_mean_3d": 1.0}), 1, shortened=s).first()["predicted_pm25"]
        for s in (False, True)
    )
    assert full == pytest.approx(sum(values[-3:]) / 3) and short == pytest.approx(sum(values[-2:]) / 2)


def test_model_learns_and_reports(spark):
    data = materialize(table_features(add_calendar(history(spark, 120), False), "pm25_daily"))
    features = [c for c in data.columns if c.startswith("pm25_")]
    model = fit(data, features, params=TREES)
    assert features_of(model) == features
    row = evaluate(score(model, data), keys=()).first()
    assert row["r2"] > 0.5
    scored = score(model, data.drop("pm25_lag_28d"))
    assert "pm25_lag_28d" not in scored.columns and scored.columns[-1] == "predicted_pm25"
    assert feature_importance(model, spark, 5).count() == 5


def readings_frame(spark, n=300):
    rng = random.Random(2)
    rows = [(f"S{rng.randrange(4)}", "north", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(3000)), float(i)) for i in range(n)]
    return spark.createDataFrame(rows, "station_id string, region string, timestamp timestamp, x double")


def test_stream_rollup_equals_batch(spark, tmp_path):
    batch = readings_frame(spark)
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    spec, root = TableSpec("hours", 1, ("region", "timestamp")), str(tmp_path / "store")
    for _ in range(2):
        keep_table_current(hourly_windows(stream, "x", "x"), spec, root, str(tmp_path / "cp")).awaitTermination()
    got = {(r["timestamp"], r["reading_count"], round(r["x_avg"], 6)) for r in read_table(spark, root, "hours").collect()}
    located = batch.withColumns({"latitude": F.lit(1.0), "longitude": F.lit(1.0)})
    want = {(r["timestamp"], r["reading_count"], round(r["x_avg"], 6)) for r in region_hour_scalar(located, "x").collect()}
    assert got == want


def test_stream_ingest_resumes(spark, tmp_path):
    landing, bronze, checkpoint = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "cp")
    spec = TableSpec("bronze", 1, ("station_id", "timestamp"), partition_by=())
    page = lambda t, v: {"code": 0, "data": {"readings": [{"timestamp": t, "data": [{"stationId": "S1", "value": v}]}]}}

    def run():
        rows = stream_station_readings(spark, str(landing))
        keep_readings(rows, spec, bronze, checkpoint).awaitTermination()
        return read_table(spark, bronze, "bronze").count()

    write(landing / "1.json", page("2024-01-01T01:00:00+08:00", 1))
    assert run() == 1
    write(landing / "2.json", page("2024-01-01T01:00:00+08:00", 1))  # delivered again
    write(landing / "3.json", page("2024-01-01T02:00:00+08:00", 2))
    assert run() == 2 and run() == 2
    write(landing / "4.json", page("2023-12-01T01:00:00+08:00", 3))  # new, and a month late
    assert run() == 3


def test_correction_refreshes_influenced_rows(spark, tmp_path):
    from aerolith.streaming.corrections import correct_features

    root, base = str(tmp_path / "store"), history(spark, 100)
    create_table(table_features(add_calendar(base, False), "pm25_daily"), FEATURE_TABLES["pm25_daily"], root)
    late = base.filter("region = 'a' AND timestamp = '2024-03-05'").withColumn("pm25", F.lit(500.0))
    assert correct_features(late, "pm25_daily", root, ["region", "timestamp", "pm25"])
    fixed = base.withColumn("pm25", F.when((F.col("region") == "a") & (F.col("timestamp") == "2024-03-05"), 500.0).otherwise(F.col("pm25")))
    want = table_features(add_calendar(fixed, False), "pm25_daily")
    columns = ["region", "timestamp", "pm25", "pm25_lag_7d", "pm25_rolling_max_28d"]
    got = {tuple(r) for r in read_table(spark, root, "pm25_daily").select(*columns).collect()}
    assert got == {tuple(r) for r in want.select(*columns).collect()}
    assert SERIES["pm25_daily"].unit == "d"


def test_upsert_keys_and_cut_off_swaps(spark, tmp_path, monkeypatch):
    """NULL and numeric-looking regions; an upsert that dies while it swaps folders is completed by the next one."""
    from aerolith.sinks import tables

    t0 = dt.datetime(2024, 1, 1)
    spec, root = TableSpec("keyed", 1, ("region", "timestamp")), str(tmp_path / "store")
    frame = lambda rows: spark.createDataFrame(rows, "region string, timestamp timestamp_ntz, x int")
    read = lambda: sorted(map(tuple, read_table(spark, root, "keyed", columns=["region", "timestamp", "x"]).collect()), key=str)
    create_table(frame([(None, t0, 1), (None, t0 + DAY, 2), ("007", t0, 3), ("7", t0, 4), ("x", t0, 5)]), spec, root)
    tables.upsert(frame([(None, t0, 10), ("007", t0, 30), ("7", t0 + DAY, 40), ("7", t0 + DAY, 41)]), spec, root)
    want = {(None, t0, 10), (None, t0 + DAY, 2), ("007", t0, 30), ("7", t0, 4), ("7", t0 + DAY, 41), ("x", t0, 5)}
    assert set(read()) == want and len(read()) == 6

    # Dies after the first of several folders has been deleted.
    real = tables.filesystem
    swap = tables._swap

    def cut_off(spark, path, staged, depth):
        fs, _ = real(spark, path)
        fs.delete(real(spark, f"{path}/{tables._folders(spark, staged, depth)[0]}")[1], True)
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(tables, "_swap", cut_off)
    with pytest.raises(RuntimeError):
        tables.upsert(frame([("x", t0, 50), ("y", t0, 60)]), spec, root)
    monkeypatch.setattr(tables, "_swap", swap)
    tables.finish_swaps(spark, spec, root)
    want = (want - {("x", t0, 5)}) | {("x", t0, 50), ("y", t0, 60)}
    assert set(read()) == want
    # Removal empties a folder.
    tables.upsert(frame([("x", t0, 51)]), spec, root, remove=frame([("y", t0, 0), (None, t0, 0)]))
    assert set(read()) == (want - {("x", t0, 50), ("y", t0, 60), (None, t0, 10)}) | {("x", t0, 51)}


def test_short_deliveries_build_up_history(spark, tmp_path):
    from aerolith.plans.series import store_series

    root, base = str(tmp_path / "store"), history(spark, 34, ("a",))
    for k in range(0, 34, 17):
        store_series(spark, base.filter(f"timestamp >= '2024-01-01' + INTERVAL {k} DAYS AND timestamp < '2024-01-01' + INTERVAL {k + 17} DAYS"), "pm25_daily", root)
    got = {tuple(r) for r in read_table(spark, root, "pm25_daily").select("timestamp", "pm25_lag_28d").collect()}
    want = {tuple(r) for r in table_features(add_calendar(base, False), "pm25_daily").select("timestamp", "pm25_lag_28d").collect()}
    assert got == want and len(want) == 6


def test_a_delivery_is_a_batch_however_many_tasks_wrote_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "_ROWS_PER_FILE", 100, raising=False)
    moment = F.expr("timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01')")
    events = spark.range(0, 900, 1, 8).select(
        F.col("id").alias("event_id"), moment.alias("ts"), (F.col("id") % 5).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"), F.lit("").alias("props"),
    )
    events.repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    batches = []
    stream = stored._event_stream(spark, str(tmp_path))
    note = lambda batch, _: batches.append([r.event_id for r in batch.select("event_id").collect()])
    stream.writeStream.foreachBatch(note).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [len(b) for b in batches] == [300, 300, 300]
    assert min(batches[0]) > max(batches[1]) and min(batches[1]) > max(batches[2])
