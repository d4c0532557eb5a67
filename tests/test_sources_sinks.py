import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators.merge import merge_station_metadata, merge_yearly
from aerolith.operators.quality import QualityError
from aerolith.schemas import MONTHLY, TableSpec
from aerolith.sinks import files as sink_files
from aerolith.sinks.tables import create_table, upsert, upsert_all
from aerolith.sources import files, landing
from aerolith.sources.tables import latest_version, read_table, table_path

START = dt.datetime(2024, 1, 30)
SPEC = TableSpec("t", 1, ("region", "timestamp"), period=MONTHLY)


def dump(path, *documents):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def station(i, name="N", lat=1.35, lon=103.94):
    return {"id": i, "deviceId": i, "name": name, "location": {"latitude": lat, "longitude": lon}}


def test_station_pages(spark, tmp_path):
    reading = lambda t, *points: {"timestamp": t, "data": [{"stationId": s, "value": v} for s, v in points]}
    path = dump(
        tmp_path / "p" / "a.json",
        {"code": 0, "data": {"stations": [station("S1", "first")], "readings": [reading("2025-01-01T00:30:00+08:00", ("S1", 1.5), ("S2", "bad"))]}},
        {"data": {"stations": [station("S1", "second")], "items": [reading("2025-01-01T01:30:00+08:00", ("S1", 2))]}},
        {"code": 4, "errorMsg": "Data NOT FOUND", "data": {}},
    )
    pages = landing.read_station_pages(spark, path)
    rows = landing.station_readings(pages).orderBy("timestamp", "station_id").collect()
    assert [(r["station_id"], r["value"]) for r in rows] == [("S1", 1.5), ("S2", None), ("S1", 2.0)]
    assert pages.count() == 2
    mentions = landing.station_mentions(pages, F.lit(1), F.col("data.stations")[0]["name"])
    assert merge_station_metadata(mentions).first()["name"] == "first"


def test_region_pages(spark, tmp_path):
    item = {"date": "2025-01-01", "timestamp": "2025-01-01T01:00:00+08:00", "updatedTimestamp": None,
            "readings": {"pm25_one_hourly": {"east": 12.4, "west": "x", "national": 9}}}
    pages = landing.read_region_pages(spark, dump(tmp_path / "r.json", {"code": 0, "data": {"items": [item]}}))
    rows = {r["region"]: r["pm25"] for r in landing.region_readings(pages).collect()}
    assert rows == {"east": 12.4, "west": None}
    wide = landing.region_readings_wide(pages)
    assert wide.first()["national"] == 9.0 and wide.first()["south"] is None
    assert [(r["region"], r["pm25"]) for r in landing.wide_to_long(wide).collect()] == [("east", 50)]


def test_weather_and_forecast_documents(spark, tmp_path):
    doc = {"daily": {"time": ["2025-01-01", "2025-01-02"], "temperature_2m_mean": [27.0, 28.0], "precipitation_sum": [0.0],
                     "wind_speed_10m_max": [3.0, 4.0], "wind_direction_10m_dominant": [90.0, 91.0]},
           "hourly": {"time": ["2025-01-01T05:00"], "temperature_2m": [26.5], "precipitation": [0.1],
                      "wind_speed_10m": [2.0], "wind_direction_10m": [10.0]}}
    weather = landing.read_weather_arrays(spark, dump(tmp_path / "w.json", doc))
    days = landing.weather_days(weather, "X").orderBy("date").collect()
    assert [d["precipitation_sum"] for d in days] == [0.0, None] and days[1]["city"] == "X"
    assert landing.weather_hours(weather).first()["time"] == dt.datetime(2025, 1, 1, 5)
    block = {"region": "north", "start_s": 0, "end_s": 10800, "interval_s": 3600, "temperature_2m": [1, 2, 3],
             "wind_speed_10m": [4, 5], "wind_direction_10m": [6, 7, 8]}
    hours = landing.forecast_hours(landing.read_forecast_blocks(spark, dump(tmp_path / "f.json", block))).orderBy("timestamp").collect()
    assert [h["wind_speed_avg"] for h in hours] == [4.0, 5.0, None] and hours[0]["latitude"] == 1.4180
    unix = spark.createDataFrame([([0, 60], [1.0, 2.0])], "t array<bigint>, v array<double>")
    assert [r["v"] for r in landing.unix_series(unix, "t", ["v"]).collect()] == [1.0, 2.0]


def test_sensor_feed(spark, tmp_path):
    feeds = [
        {"status": "ok", "sensor_id": 1, "data": {"aqi": 5, "dominentpol": "o3", "time": {"iso": "2025-01-01T00:00:00+08:00"}, "iaqi": {"pm25": {"v": 55}, "o3": {"v": 2}}}},
        {"status": "ok", "sensor_id": 2, "data": {"aqi": 6, "time": {"iso": "x"}, "iaqi": {}}},
        {"status": "error", "sensor_id": 3},
    ]
    feed = landing.read_sensor_feed(spark, dump(tmp_path / "s.json", *feeds))
    got = {r["sensor_id"]: r["pm25"] for r in landing.feed_pm25(feed, "X", F.current_date()).collect()}
    assert got == {1: 55.0, 2: None}
    wide = landing.feed_pollutants(feed, ["pm25", "no2"]).orderBy("sensor_id").first()
    assert wide["iaqi_pm25"] == 55.0 and wide["iaqi_no2"] is None
    assert landing.feed_pollutants_long(feed).count() == 2


def test_csv_sources(spark, tmp_path):
    (tmp_path / "dump.csv").write_text(
        "date,timestamp,update_timestamp,station_id,station_name,station_device_id,location_longitude,location_latitude,"
        "reading_update_timestamp,reading_value,reading_type,reading_unit\n"
        "2024-01-01,2024-01-01T00:05:00+08:00,,S1,A B,d,103.8,1.3,2024-01-01T00:06:00+08:00,4.5,t,u\n"
        "2024-01-01,2024-01-01T00:10:00+08:00,,S1,A B,d,103.8,1.3,,oops,t,u\n"
    )
    raw = files.read_reading_dump(spark, str(tmp_path / "dump.csv"), "wind_speed")
    assert raw.columns == ["date", "timestamp", "station_name", "longitude", "latitude", "reading_update_timestamp", "wind_speed"]
    assert [r["wind_speed"] for r in raw.orderBy("timestamp").collect()] == [4.5, None]

    days = tmp_path / "daily"
    days.mkdir()
    (days / "east-air.csv").write_text("date, pm25, pm10, o3, no2, so2, co, psi\n2015/1/1, 9, , , , , , \n2024/1/2, 57, 1, 2, 3, 4, 5, 6\n")
    (days / "west-air.csv").write_text("date, pm25, pm10, o3, no2, so2, co, psi\n2024/1/3, -, , , , , , \n")
    got = {(r["region"], str(r["date"]), r["pm25"]) for r in files.read_region_daily(spark, str(days)).collect()}
    assert got == {("east", "2015-01-01", 9.0), ("east", "2024-01-02", 57.0), ("west", "2024-01-03", None)}
    sensor = files.read_sensor_days(spark, str(days / "east-air.csv"), 7, "X").collect()
    assert [(r["sensor_id"], r["pm25"]) for r in sensor] == [(7, 57.0)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_station_metadata(spark, str(tmp_path / "nowhere.csv")).count()

    header = "timestamp,station_id,station_name,wind_speed_avg,reading_count,latitude,longitude,last_update\n"
    for year, rows in {"2023": "2023-12-31 23:00:00,S1,A,1.0,3,1.3,103.8,\n", "2024": "2023-12-31 23:00:00,S1,A,9.0,3,1.3,103.8,\n2024-01-01 00:00:00,S1,A,2.0,3,1.3,103.8,\n"}.items():
        (tmp_path / year).mkdir()
        (tmp_path / year / "a-wind-speed-hourly.csv").write_text(header + rows + ",,,,,,,\n")
    yearly = files.read_yearly_stations(spark, {y: str(tmp_path / y) for y in ("2023", "2024")}, pattern="*-wind-speed-*.csv")
    merged = merge_yearly(yearly).orderBy("timestamp").collect()
    assert [r["wind_speed_avg"] for r in merged] == [1.0, 2.0]
    sink_files.write_station_csv(merge_yearly(yearly), str(tmp_path / "out"))
    assert (tmp_path / "out" / "station=A").exists()
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == 2


def rows(spark, *values):
    return spark.createDataFrame(
        [(r, START + dt.timedelta(days=d), float(v)) for r, d, v in values], "region string, timestamp timestamp_ntz, pm25 double"
    )


def content(spark, root, **options):
    return {(r["region"], r["timestamp"].day, r["pm25"]) for r in read_table(spark, root, "t", **options).collect()}


def test_upsert(spark, tmp_path):
    root = str(tmp_path / "store")
    assert upsert(rows(spark).limit(0), SPEC, root) is False
    create_table(rows(spark, ("a", 0, 1), ("a", 1, 2), ("a", 3, 3), ("b", 0, 4)), SPEC, root)
    with pytest.raises(FileExistsError):
        create_table(rows(spark, ("a", 0, 1)), SPEC, root)
    untouched = sorted(p for p in (tmp_path / "store" / "t" / "v=1" / "region=b").rglob("*.parquet"))
    batch = rows(spark, ("a", 1, 20), ("a", 1, 21), ("a", 2, 30), ("c", 0, 50))
    for _ in range(2):
        assert upsert(batch, SPEC, root, order=["pm25"]) is True
        assert content(spark, root) == {("a", 30, 1), ("a", 31, 21), ("a", 1, 30), ("a", 2, 3), ("b", 30, 4), ("c", 30, 50)}
    assert untouched == sorted(p for p in (tmp_path / "store" / "t" / "v=1" / "region=b").rglob("*.parquet"))
    assert content(spark, root, since="2024-01-31", regions=["a"]) == {("a", 31, 21), ("a", 1, 30), ("a", 2, 3)}
    assert content(spark, root, before="2024-01-31") == {("a", 30, 1), ("b", 30, 4), ("c", 30, 50)}
    assert latest_version(spark, root, "t") == 1
    with pytest.raises(FileNotFoundError):
        latest_version(spark, root, "other")
    with pytest.raises(QualityError):
        upsert(rows(spark, ("a", 0, -5)), SPEC, root, expectations=[("pm25", -0.1, 500.0)])


def test_time_bounds_prune_folders(spark, tmp_path):
    root = str(tmp_path / "store")
    create_table(rows(spark, *[("a", 31 * i, i) for i in range(6)]), SPEC, root)
    plan = read_table(spark, root, "t", since="2024-05-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_key" in plan or "period_key" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "PushedFilters" in plan and "GreaterThanOrEqual(timestamp" in plan


def test_upsert_several_and_comments(spark, tmp_path):
    root = str(tmp_path / "store")
    day = spark.sql("SELECT 'X' AS city, 1 AS sensor_id, DATE'2024-01-01' AS date, 1.0 AS pm25")
    assert upsert_all({"air_quality": day, "weather": day.select("city", "date").limit(0)}, root) == {"air_quality": True, "weather": False}
    stored = spark.read.parquet(table_path(root, "air_quality", schemas.FEATURE_TABLES["air_quality"].version))
    assert "comment" in stored.schema["pm25"].metadata


def test_rejected_lines(spark, tmp_path):
    head = "timestamp,station_id,station_name,wind_speed_avg,reading_count,latitude,longitude,last_update"
    good = "2024-01-01T00:00:00Z,x,Old,2.5,3,1.0,1.0,2024-01-01T00:00:00Z"
    lines = [head, "2024-01-01T00:00:00Z,x", f"{good},too,many", good.replace("Old", ""), good, good.replace("2.5", "bad")]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.csv").write_text(f"{head}\n{good}\n")
    rows = files.rejected_lines(spark, str(tmp_path))
    assert sorted(map(tuple, rows.collect())) == sorted(
        [("a.csv", "corrupt", lines[1]), ("a.csv", "corrupt", lines[2]), ("a.csv", "no station_name", lines[3]), ("a.csv", "corrupt", lines[5])]
    )
    assert {r.reason: r["count"] for r in rows.groupBy("reason").count().collect()} == {"corrupt": 3, "no station_name": 1}


def test_many_station_folders_are_listed_by_few_tasks(spark, tmp_path):
    stations, path = 60, str(tmp_path / "stations")
    names = [c.split()[0] for c in schemas.STATION_HOURLY_SPEED.replace("\n", " ").split(",")]
    values = {"station_name": F.concat(F.lit("Old / "), "id"), "timestamp": F.lit("2024-01-01T00:00:00Z")}
    rows = spark.range(stations).select(*[values.get(n, F.lit(None).cast("string")).alias(n) for n in names])
    sink_files.write_station_csv(rows, path)
    threshold, tasks = "spark.sql.sources.parallelPartitionDiscovery.threshold", "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, status = spark.conf.get(threshold), spark.sparkContext.statusTracker()
    usual = spark.conf.get(tasks)
    spark.conf.set(threshold, "8")
    spark.sparkContext.setJobGroup("station-listing", "")
    try:
        found = files.read_station_files(spark, path)
    finally:
        spark.conf.set(threshold, before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [s for j in status.getJobIdsForGroup("station-listing") for s in status.getJobInfo(j).stageIds]
    assert stages and max(status.getStageInfo(s).numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism < stations
    assert spark.conf.get(tasks) == usual
    assert {r.station_name for r in found.collect()} == {f"Old / {i}" for i in range(stations)}
