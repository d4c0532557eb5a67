"""Files written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions.times import hour_start, local_clock
from aerolith.operators import merge
from aerolith.registry import adapters as a
from aerolith.registry import query
from aerolith.registry.documents import region_pages, station_pages
from aerolith.schemas import TableSpec
from aerolith.session import work_path
from aerolith.sinks import files as sinks
from aerolith.sources import files, landing
from aerolith.sources.tables import read_table
from aerolith.streaming.ingest import keep_readings, stream_region_readings

_BROKEN = ('{"code": 0, "data": {"readings": [{"timestamp": "2024-01', '{"code": 7, "errorMsg": "data not found"}')


def _landed(spark, pages, name: str) -> str:
    """Pages as lines of JSON files, a truncated one and one that reports an error among them."""
    path = work_path(spark, name)
    text = F.to_json(F.struct(F.lit(0).alias("code"), F.col("data")))
    pages.select(text.alias("value")).write.text(path)
    spark.createDataFrame([(line,) for line in _BROKEN], "value string").write.mode("append").text(path)
    return path


@query(
    "station_page_files",
    f"""WITH {a.READINGS} SELECT "timestamp", station_id, {a.sql_round('TRY_CAST(value_text AS DOUBLE)', 'value')} FROM readings""",
)
def station_page_files(spark, sf_dir):
    path = _landed(spark, station_pages(spark, sf_dir), "station_pages")
    out = landing.station_readings(landing.read_station_pages(spark, path))
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "rejected_page_counts",
    """SELECT * FROM (VALUES ('code 7', 1), ('corrupt', 1), ('kept', (SELECT count(DISTINCT event_id // 200) FROM events))) t(reason, n)""",
)
def rejected_page_counts(spark, sf_dir):
    path = _landed(spark, station_pages(spark, sf_dir), "rejected_pages")
    rejected = landing.rejected_pages(spark, path).select("reason")
    kept = landing.read_station_pages(spark, path).select(F.lit("kept").alias("reason"))
    return rejected.unionByName(kept).groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "region_page_files",
    f"""WITH hours AS (SELECT date_trunc('hour', ts) AS "timestamp", CASE event_type WHEN 'click' THEN 'east' WHEN 'error' THEN 'west'
      WHEN 'purchase' THEN 'north' WHEN 'view' THEN 'south' END AS region, round(avg(value), 4) AS pm25 FROM events GROUP BY 1, 2)
    SELECT "timestamp", region, {a.sql_round('pm25', 'pm25')} FROM hours WHERE region IS NOT NULL""",
)
def region_page_files(spark, sf_dir):
    path = _landed(spark, region_pages(spark, sf_dir), "region_pages")
    out = landing.region_readings(landing.read_region_pages(spark, path))
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "stream_region_page_files",
    f"""WITH hours AS (SELECT date_trunc('hour', ts) AS "timestamp", CASE event_type WHEN 'click' THEN 'east' WHEN 'error' THEN 'west'
      WHEN 'purchase' THEN 'north' WHEN 'view' THEN 'south' END AS region, round(avg(value), 4) AS pm25 FROM events GROUP BY 1, 2)
    SELECT "timestamp", region, {a.sql_round('pm25', 'pm25')} FROM hours WHERE region IS NOT NULL""",
)
def stream_region_page_files(spark, sf_dir):
    """The region pages as a stream of files, merged into a stored table by key."""
    path, root = _landed(spark, region_pages(spark, sf_dir), "region_page_stream"), work_path(spark, "region_stream")
    readings = stream_region_readings(spark, path, files_per_trigger=2).select("timestamp", "region", "pm25")
    keep_readings(readings, TableSpec("region_hours", 1, ("region", "timestamp")), root, f"{root}/checkpoint").awaitTermination()
    out = read_table(spark, root, "region_hours").withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.rounded(out.select("timestamp", "region", "pm25"))


def _weather_document(days, hours):
    """One document of parallel arrays, days and hours in order."""
    daily = {"time": F.date_format("timestamp", "yyyy-MM-dd"), "temperature_2m_mean": F.col("air_temperature_avg_mean"),
             "precipitation_sum": F.col("precipitation_sum").cast("double"), "wind_speed_10m_max": F.col("wind_speed_avg_mean"),
             "wind_direction_10m_dominant": F.col("wind_direction_avg_mean")}
    hourly = {"time": F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm"), "temperature_2m": F.col("air_temperature_avg"),
              "precipitation": F.lit(0.5), "wind_speed_10m": F.col("wind_speed_avg"), "wind_direction_10m": F.col("pm25")}

    def arrays(df, columns, name):
        rows = df.agg(F.sort_array(F.collect_list(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("r"))
        return rows.select(F.struct(*[F.col(f"r.{n}").alias(n) for n in columns]).alias(name))

    return arrays(days, daily, "daily").join(arrays(hours, hourly, "hourly"))


def _weather_files(spark, sf_dir):
    """(region, type) and the documents read from a file each: the days of a region, the hours of a type of event."""
    weather, hours = a.materialize(a.weather(spark, sf_dir)), a.materialize(a.hourly(spark, sf_dir))
    pairs = zip(("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"), ("click", "error", "purchase", "signup", "view"))
    for region, kind in pairs:
        path = work_path(spark, "weather_arrays")
        documents = _weather_document(weather.filter(F.col("region") == region), hours.filter(F.col("region") == kind))
        documents.select(F.to_json(F.struct("daily", "hourly")).alias("value")).coalesce(1).write.text(path)
        yield region, kind, landing.read_weather_arrays(spark, path)


@query(
    "weather_day_files",
    f"""WITH {a.DAILY} SELECT CAST("timestamp" AS DATE) AS date, region AS city, {a.sql_round('air_temperature_avg_mean', 'temperature_2m_mean')},
      {a.sql_round('precipitation_sum', 'precipitation_sum')}, {a.sql_round('wind_speed_avg_mean', 'wind_speed_10m_max')},
      {a.sql_round('wind_direction_avg_mean', 'wind_direction_10m_dominant')} FROM weather""",
)
def weather_day_files(spark, sf_dir):
    out = None
    for region, _, documents in _weather_files(spark, sf_dir):
        days = landing.weather_days(documents, region)
        out = days if out is None else out.unionByName(days)
    return a.rounded(out.withColumn("precipitation_sum", F.col("precipitation_sum").cast("double")))


@query(
    "weather_hour_files",
    f"""WITH {a.HOURLY} SELECT region AS kind, "timestamp" AS time, {a.sql_round('air_temperature_avg', 'temperature_2m')},
      0.5e0 AS precipitation, {a.sql_round('wind_speed_avg', 'wind_speed_10m')}, {a.sql_round('pm25', 'wind_direction_10m')}
    FROM hourly""",
)
def weather_hour_files(spark, sf_dir):
    out = None
    for _, kind, documents in _weather_files(spark, sf_dir):
        hours = landing.weather_hours(documents).withColumn("kind", F.lit(kind))
        out = hours if out is None else out.unionByName(hours)
    return a.rounded(out.withColumn("time", local_clock(F.col("time"), "UTC")))


@query(
    "unix_series_files",
    f"""WITH {a.READINGS} SELECT station_id, date_trunc('second', "timestamp") AS "timestamp", {a.sql_round('wind_speed', 'wind_speed')} FROM readings""",
)
def unix_series_files(spark, sf_dir):
    """Arrays of seconds and of values by station and day, written as JSON and read into rows."""
    path = work_path(spark, "unix_series")
    r = a.readings(spark, sf_dir)
    pair = F.struct(F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("s"), F.col("wind_speed").alias("v"))
    rows = r.groupBy("station_id", F.to_date("timestamp").alias("day")).agg(F.sort_array(F.collect_list(pair)).alias("p"))
    rows.select("station_id", F.col("p.s").alias("seconds"), F.col("p.v").alias("wind_speed")).write.json(path)
    documents = spark.read.schema("station_id string, seconds array<bigint>, wind_speed array<double>").json(path)
    out = landing.unix_series(documents, "seconds", ["wind_speed"], keep=["station_id"])
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "rejected_line_counts",
    """WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS h FROM events)
    SELECT * FROM (VALUES ('corrupt', 2), ('no station_name', 1), ('kept', (SELECT count(*) FROM h) + 2)) t(reason, n)""",
)
def rejected_line_counts(spark, sf_dir):
    """Station files with lines of too few and too many fields and one without a station, beside good ones.  The line of
    too many fields is read as far as it goes, and reported."""
    path = work_path(spark, "broken_stations")
    names = [c.split()[0] for c in schemas.STATION_HOURLY_SPEED.replace("\n", " ").split(",")]
    values = {"timestamp": _iso(F.col("hour")), "station_name": F.col("station_name"), "reading_count": F.col("reading_count"),
              "wind_speed_avg": F.col("wind_speed_avg"), "last_update": _iso(F.col("hour"))}
    rows = _station_hours(spark, sf_dir).select(*[values.get(n, F.lit(1.0) if "itude" in n else F.lit("x")).alias(n) for n in names])
    rows.write.option("header", True).csv(path)
    good = "2024-01-01T00:00:00Z,x,Old,2.5,3,1.0,1.0,2024-01-01T00:00:00Z"
    lines = [",".join(names), "2024-01-01T00:00:00Z,x", f"{good},too,many", good.replace("Old", ""), good]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)
    rejected = files.rejected_lines(spark, path).select("reason")
    kept = files.read_station_files(spark, path).select(F.lit("kept").alias("reason"))
    return rejected.unionByName(kept).groupBy("reason").agg(F.count("*").alias("n"))


def _iso(ts):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


@query(
    "reading_dump_file",
    f"""WITH {a.READINGS} SELECT "timestamp", station_id AS station_name, {a.sql_round('TRY_CAST(value_text AS DOUBLE)', 'wind_speed')},
       {a.sql_round('latitude', 'latitude')}, {a.sql_round('longitude', 'longitude')} FROM readings""",
)
def reading_dump_file(spark, sf_dir):
    """A dump of single readings with all of its columns, written as CSV and read typed."""
    path = work_path(spark, "dump")
    r = a.readings(spark, sf_dir)
    values = {
        "date": F.to_date("timestamp"), "timestamp": _iso(F.col("timestamp")), "station_name": F.col("station_id"),
        "reading_value": F.col("value_text"), "location_longitude": F.col("longitude"), "location_latitude": F.col("latitude"),
    }
    names = [c.split()[0] for c in schemas.READING_DUMP.replace("\n", " ").split(",")]
    r.select(*[values.get(n, F.lit("x")).alias(n) for n in names]).write.option("header", True).csv(path)
    out = files.read_reading_dump(spark, path, value="wind_speed").withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.rounded(out.select("timestamp", "station_name", "wind_speed", "latitude", "longitude"))


def _station_hours(spark, sf_dir):
    hours = a.readings(spark, sf_dir).groupBy(
        F.concat(F.lit("Old / "), F.col("station_id")).alias("station_name"), hour_start(F.col("timestamp")).alias("hour")
    )
    return hours.agg(F.round(F.avg("wind_speed"), 6).alias("wind_speed_avg"), F.count("*").alias("reading_count"))


@query(
    "station_csv_years",
    f"""WITH {a.READINGS} SELECT 'Old / ' || station_id AS station_name, date_trunc('hour', "timestamp") AS "timestamp",
       {a.sql_round('avg(wind_speed)', 'wind_speed_avg')}, count(*) AS reading_count FROM readings GROUP BY 1, 2""",
)
def station_csv_years(spark, sf_dir):
    """Two yearly exports of the same hours, scanned, merged and exported again: the earlier year stays."""
    hours = a.materialize(_station_hours(spark, sf_dir))  # both years export the same hours
    names = [c.split()[0] for c in schemas.STATION_HOURLY_SPEED.replace("\n", " ").split(",")]
    directories = {}
    for year, factor in (("2023", 1), ("2024", 2)):
        values = {
            "timestamp": _iso(F.col("hour")), "station_name": F.col("station_name"), "reading_count": F.col("reading_count"),
            "wind_speed_avg": F.col("wind_speed_avg") * factor, "last_update": _iso(F.col("hour")),
        }
        directories[year] = work_path(spark, f"stations_{year}")
        rows = hours.select(*[values.get(n, F.lit(1.0) if "itude" in n else F.lit("x")).alias(n) for n in names])
        rows.write.option("header", True).csv(directories[year])
    merged = merge.merge_yearly(files.read_yearly_stations(spark, directories))
    out = work_path(spark, "merged_stations")
    written = merged.withColumns({"timestamp": _iso(local_clock(F.col("timestamp"), "UTC")), "last_update": F.lit(None).cast("string")})
    sinks.write_station_csv(written.withColumn("station_id", F.lit("x")).select(*names), out)
    again = files.read_station_files(spark, out)
    again = again.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.rounded(again.select("station_name", "timestamp", "wind_speed_avg", "reading_count"))


@query(
    "station_metadata_file",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'd' || s_suppkey AS device_id,
       round(s_suppkey / 8e0, 6) AS latitude, round(s_suppkey / 16e0, 6) AS longitude FROM supplier""",
)
def station_metadata_file(spark, sf_dir):
    path = work_path(spark, "stations")
    key = F.col("s_suppkey")
    rows = a.table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("d"), key).alias("device_id"),
        (key / 8).alias("latitude"), (key / 16).alias("longitude"),
    )
    sinks.write_small_csv(rows, path)
    return a.rounded(files.read_station_metadata(spark, path))


def _region_files(spark, df, name: str, date: str):
    """One file per region, named ``<region>-<name>.csv``, as downloads are."""
    path = work_path(spark, name)
    sinks.write_region_csv(df, f"{path}/parts", order=date)
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    new = spark._jvm.org.apache.hadoop.fs.Path
    for folder in fs.listStatus(new(f"{path}/parts")):
        region = folder.getPath().getName().partition("=")[2]
        if folder.isDirectory():
            for i, part in enumerate(s for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("part-")):
                fs.rename(part.getPath(), new(f"{path}/{region}-{name}-{i}.csv"))
    return f"{path}/*.csv"


@query(
    "region_hourly_files",
    f"""WITH {a.HOURLY} SELECT "timestamp", lower(region) AS region, {a.sql_round('pm25', 'pm25')} FROM hourly""",
)
def region_hourly_files(spark, sf_dir):
    h = a.hourly(spark, sf_dir)
    rows = h.select(
        F.lower("region").alias("region"), _iso(F.col("timestamp")).alias("timestamp"), F.to_date("timestamp").alias("date"),
        F.col("pm25").cast("string").alias("pm25"),
    )
    out = files.read_region_hourly(spark, _region_files(spark, rows, "hourly", "timestamp"))
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


def _daily_rows(spark, sf_dir):
    return a.daily(spark, sf_dir).select(
        F.translate(F.lower("region"), " ", "").alias("region"), F.date_format("timestamp", "yyyy/M/d").alias("date"),
        F.concat(F.lit(" "), F.col("pm25").cast("string"), F.lit(" ")).alias("pm25"),
        *[F.lit(" ").alias(n) for n in ("pm10", "o3", "no2", "so2", "co", "psi")],
    )


@query(
    "region_daily_files",
    f"""WITH {a.DAILY} SELECT CAST("timestamp" AS DATE) AS date, replace(lower(region), ' ', '') AS region,
       {a.sql_round('pm25', 'pm25')} FROM daily""",
)
def region_daily_files(spark, sf_dir):
    """Blanks around values, slashes and no leading zeros in dates, the region in the file's name."""
    path = _region_files(spark, _daily_rows(spark, sf_dir), "daily", "date")
    return a.rounded(files.read_region_daily(spark, path))


@query(
    "sensor_daily_file",
    f"""WITH {a.DAILY} SELECT CAST("timestamp" AS DATE) AS date, round(CAST(CAST(pm25 AS FLOAT) AS DOUBLE), 6) + 0.0 AS pm25,
       'Here' AS city, 12 AS sensor_id FROM daily WHERE "timestamp" >= TIMESTAMP '1998-01-01'""",
)
def sensor_daily_file(spark, sf_dir):
    path = work_path(spark, "sensor")
    _daily_rows(spark, sf_dir).drop("region").write.option("header", True).csv(path)
    return a.rounded(files.read_sensor_days(spark, path, 12, "Here", since="1998-01-01"))
