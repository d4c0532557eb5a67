"""Stored tables, streams and user functions.

Tables and stream state go below the shared folder named by the session.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.functions.geo import nearest_region
from aerolith.functions.times import hour_start, local_clock
from aerolith.operators.clean import column_descriptions, column_profile, preview, valid_directions
from aerolith.operators.groups import apply_to_groups, group_aggregate
from aerolith.plans.ingest import store_features
from aerolith.plans.series import store_series
from aerolith.registry import query
from aerolith.registry import adapters as a
from aerolith.registry.features import _calendar_sql, _expected, _features_sql
from aerolith.schemas import FEATURE_TABLES, TableSpec
from aerolith.session import materialize, work_path
from aerolith.sinks.tables import create_table, upsert
from aerolith.sources.tables import read_table
from aerolith.streaming.corrections import correct_features, correct_from_stream
from aerolith.streaming.ingest import keep_readings
from aerolith.streaming.log import append_to_log, close_hours, correct_hours, read_hours
from aerolith.streaming.rollup import keep_hours_current

_SERIES = TableSpec("pm25_base", 1, ("region", "timestamp"))


@query(
    "feature_table_read",
    f"""WITH {a.DAILY} SELECT region, "timestamp", {a.sql_round('pm25', 'pm25')} FROM daily
    WHERE "timestamp" >= TIMESTAMP '1999-03-15' AND "timestamp" < TIMESTAMP '2000-06-01' AND region IN ('ASIA', 'EUROPE')""",
)
def feature_table_read(spark, sf_dir):
    root = work_path(spark, "table_read")
    create_table(a.daily(spark, sf_dir).withColumn("unused", F.lit(1)), _SERIES, root)
    out = read_table(
        spark, root, "pm25_base", columns=["region", "timestamp", "pm25"], since="1999-03-15", before="2000-06-01",
        regions=["ASIA", "EUROPE"],
    )
    return a.rounded(out)


@query(
    "feature_table_upsert",
    f"""WITH {a.DAILY} SELECT region, "timestamp",
       {a.sql_round('''CASE WHEN "timestamp" >= TIMESTAMP '2000-01-15' THEN pm25 + 100 ELSE pm25 END''', 'pm25')}
    FROM daily""",
)
def feature_table_upsert(spark, sf_dir):
    """Store the years before mid-2000, then upsert corrected and later rows, twice."""
    root = work_path(spark, "table_upsert")
    series = a.daily(spark, sf_dir)
    create_table(series.filter("timestamp < '2000-07-01'"), _SERIES, root)
    batch = series.filter("timestamp >= '2000-01-15'").withColumn("pm25", F.col("pm25") + 100)
    upsert(batch, _SERIES, root)
    upsert(batch, _SERIES, root)
    return a.rounded(read_table(spark, root, "pm25_base"))


def _corrected_sql(corrected: str) -> str:
    return _features_sql(
        f"{a.DAILY}, corrected AS ({corrected})", "corrected", _expected("pm25_daily"), ["pm25"], ["region"], '"timestamp"',
        _calendar_sql('"timestamp"', False), ["region", "timestamp"],
    )


def _correct(spark, series, changed, name: str):
    """Store a series, correct some of its rows, and read the features."""
    root = work_path(spark, name)
    store_series(spark, series, "pm25_daily", root)
    correct_features(changed, "pm25_daily", root, ["region", "timestamp", "pm25"])
    return a.rounded(read_table(spark, root, "pm25_daily"))


@query(
    "feature_table_upsert_keys",
    f"""WITH {a.DAILY}, k AS (SELECT CASE region WHEN 'ASIA' THEN NULL WHEN 'EUROPE' THEN '007' WHEN 'AFRICA' THEN '7'
      ELSE region END AS region, "timestamp", pm25 FROM daily)
    SELECT region, "timestamp",
       {a.sql_round("""CASE WHEN "timestamp" >= TIMESTAMP '2000-01-15' THEN pm25 + 100 ELSE pm25 END""", 'pm25')} FROM k""",
)
def feature_table_upsert_keys(spark, sf_dir):
    """Keys that are NULL or look like numbers survive being stored, updated and read."""
    root = work_path(spark, "table_keys")
    region = F.col("region")
    named = F.when(region == "EUROPE", "007").when(region == "AFRICA", "7").when(region != "ASIA", region)
    series = materialize(a.daily(spark, sf_dir).withColumn("region", named))
    create_table(series.filter("timestamp < '2000-07-01'"), _SERIES, root)
    upsert(series.filter("timestamp >= '2000-01-15'").withColumn("pm25", F.col("pm25") + 100), _SERIES, root)
    return a.rounded(read_table(spark, root, "pm25_base"))


@query(
    "late_corrections",
    _corrected_sql("""SELECT region, "timestamp",
      CASE WHEN "timestamp" = TIMESTAMP '2001-01-05' THEN pm25 + 50 ELSE pm25 END AS pm25 FROM daily"""),
)
def late_corrections(spark, sf_dir):
    """Correct one day of the stored series; features of the days it influences follow."""
    series = materialize(a.daily(spark, sf_dir))
    changed = series.filter("timestamp = '2001-01-05'").withColumn("pm25", F.col("pm25") + 50)
    return _correct(spark, series, changed, "corrections")


@query(
    "late_corrections_early",
    _corrected_sql("""SELECT region, "timestamp",
      CASE WHEN row_number() OVER (PARTITION BY region ORDER BY "timestamp") = 31 THEN pm25 + 50 ELSE pm25 END AS pm25 FROM daily"""),
)
def late_corrections_early(spark, sf_dir):
    """A correction soon after warm-up, whose windows reach back to rows without features."""
    series = materialize(a.daily(spark, sf_dir))
    nth = F.row_number().over(Window.partitionBy("region").orderBy("timestamp"))
    changed = series.withColumn("n", nth).filter("n = 31").drop("n").withColumn("pm25", F.col("pm25") + 50)
    return _correct(spark, series, changed, "corrections_early")


@query(
    "late_corrections_gaps",
    _corrected_sql("""SELECT region, "timestamp",
      CASE WHEN row_number() OVER (PARTITION BY region ORDER BY "timestamp") = 80 THEN pm25 + 50 ELSE pm25 END AS pm25
      FROM (SELECT region, pm25, CAST(DATE '1970-01-01' + CAST(3 * date_diff('day', DATE '1970-01-01', CAST("timestamp" AS DATE))
            AS INTEGER) AS TIMESTAMP) AS "timestamp" FROM daily) d"""),
)
def late_corrections_gaps(spark, sf_dir):
    """The series with every day stretched to three: windows count rows, however far apart."""
    day = F.date_from_unix_date(3 * F.unix_date(F.to_date("timestamp")))
    series = materialize(a.daily(spark, sf_dir).select("region", day.cast("timestamp_ntz").alias("timestamp"), "pm25"))
    nth = F.row_number().over(Window.partitionBy("region").orderBy("timestamp"))
    changed = series.withColumn("n", nth).filter("n = 80").drop("n").withColumn("pm25", F.col("pm25") + 50)
    return _correct(spark, series, changed, "corrections_gaps")


@query(
    "late_corrections_stream",
    _corrected_sql("""SELECT region, "timestamp",
      pm25 + CASE "timestamp" WHEN TIMESTAMP '2001-01-05' THEN 50 WHEN TIMESTAMP '2000-03-02' THEN -20 ELSE 0 END AS pm25 FROM daily"""),
)
def late_corrections_stream(spark, sf_dir):
    """Corrections as a stream of files, the later day first."""
    series, root, landing = materialize(a.daily(spark, sf_dir)), work_path(spark, "corrections_stream"), work_path(spark, "changes")
    store_series(spark, series, "pm25_daily", root)
    for day, change in (("2001-01-05", 50), ("2000-03-02", -20)):
        changed = series.filter(F.col("timestamp") == F.lit(day).cast("timestamp_ntz")).withColumn("pm25", F.col("pm25") + change)
        changed.coalesce(1).write.mode("append").parquet(landing)
    changes = spark.readStream.schema(series.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    correct_from_stream(changes, "pm25_daily", root, ["region", "timestamp", "pm25"], f"{root}/checkpoint").awaitTermination()
    return a.rounded(read_table(spark, root, "pm25_daily"))


@query(
    "stored_column_descriptions",
    f"""WITH {a.DAILY} SELECT * FROM (VALUES
      ('date', 'date', 'Day of the reading', (SELECT count("timestamp") FROM daily)),
      ('city', 'string', 'City of the sensor', (SELECT count(region) FROM daily)),
      ('pm25', 'double', 'Fine particulate matter below 2.5 micrometres', (SELECT count(pm25) FROM daily)),
      ('sensor_id', 'int', 'Sensor that took the reading', (SELECT count(*) FROM daily)),
      ('n_readings', 'int', NULL, (SELECT count(*) FROM daily))) t("column", type, comment, present)""",
)
def stored_column_descriptions(spark, sf_dir):
    """Descriptions that a table was stored with, read back beside the columns' counts."""
    root, spec = work_path(spark, "described"), FEATURE_TABLES["air_quality"]
    days = a.daily(spark, sf_dir).select(
        F.to_date("timestamp").alias("date"), F.col("region").alias("city"), "pm25", F.lit(1).alias("sensor_id"), F.lit(3).alias("n_readings")
    )
    create_table(days, spec, root)
    stored = read_table(spark, root, spec.name, spec.version, event_time="date")
    counts = column_profile(stored).select("column", "present")
    return column_descriptions(stored).join(counts, "column")


@query(
    "preview_rows",
    f"""WITH {a.DAILY} SELECT region, "timestamp", {a.sql_round('pm25', 'pm25')} FROM daily ORDER BY "timestamp" DESC, region LIMIT 5""",
)
def preview_rows(spark, sf_dir):
    return a.rounded(preview(a.daily(spark, sf_dir).select("region", "timestamp", "pm25"), [F.desc("timestamp"), "region"]))


@query(
    "daily_ingest_increment",
    _features_sql(
        a.HOURLY, "hourly", _expected("pm25_hourly"), ["pm25"], ["region"], '"timestamp"', _calendar_sql('"timestamp"', True),
        ["region", "timestamp"],
    ),
)
def daily_ingest_increment(spark, sf_dir):
    """All days but the last stored at once, then the last one ingested: as if all had come at once."""
    root = work_path(spark, "increment")
    series = materialize(a.hourly(spark, sf_dir).select("region", "timestamp", "pm25"))
    last = series.agg(F.max(F.to_date("timestamp"))).first()[0]
    for part in (F.to_date("timestamp") < F.lit(last), F.to_date("timestamp") >= F.lit(last)):
        store_features(spark, {"pm25_hourly": series.filter(part)}, root)
    return a.rounded(read_table(spark, root, "pm25_hourly"))


#: Rows of a file of the stream's landing folder.
_ROWS_PER_FILE = 200_000


def _event_stream(spark, sf_dir):
    """The readings as a stream of three deliveries in reverse order of time, one a batch.

    A delivery is as many files as its rows need, however many tasks wrote the table: a batch of a single file would
    be a slice of all days of its third, and every batch rewrites the folders that it touches.
    Watermarks need instants, so the clock is read as UTC.
    """
    events = a.table(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"), F.count("ts").alias("n")).first()
    landing = work_path(spark, "landing")
    third, n_files = (ends.high - ends.low) / 3, -(-ends.n // (3 * _ROWS_PER_FILE)) or 1
    for k in (2, 1, 0):
        part = events.filter(F.col("ts") >= F.lit(ends.low + k * third)) if k else events
        if k < 2:
            part = part.filter(F.col("ts") < F.lit(ends.low + (k + 1) * third))
        part.repartition(n_files).write.mode("append").parquet(landing)
    files = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", n_files).parquet(landing)
    user = F.col("user_id")
    return files.select(
        "event_id",
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()).alias("timestamp"),
        F.concat(F.lit("S"), user.cast("string")).alias("station_id"),
        (((F.col("event_id") * 37) % 400 - 20).cast("double") + (F.col("value") - F.floor("value"))).alias("wind_direction"),
        (F.col("value") / a.SCALE).alias("wind_speed"),
        nearest_region(
            F.lit(1.20) + (user % 50).cast("double") * 0.005, F.lit(103.60) + ((user * 7) % 150).cast("double") * 0.003
        ).alias("region"),
    )


@query(
    "stream_hourly_rollup",
    f"""WITH {a.READINGS}
    SELECT region, date_trunc('hour', "timestamp") AS "timestamp",
           {a.sql_wrapped(a.sql_circular_mean('wind_direction'), 'wind_direction_avg')},
           {a.sql_round(a.sql_circular_std('wind_direction'), 'wind_direction_std')}, count(*) AS reading_count
    FROM valid GROUP BY 1, 2""",
)
def stream_hourly_rollup(spark, sf_dir):
    """Several batches, the newest readings first: late hours are counted like all others."""
    root = work_path(spark, "stream_rollup")
    readings = valid_directions(_event_stream(spark, sf_dir), "wind_direction")
    raw = TableSpec("readings", 1, ("region", "event_id", "timestamp"))
    hours = TableSpec("hours", 1, ("region", "timestamp"))
    keep_hours_current(
        readings.select("event_id", "region", "timestamp", "wind_direction"), "wind_direction", "wind_direction", raw, hours,
        root, f"{root}/checkpoint", circular=True,
    ).awaitTermination()
    out = read_table(spark, root, "hours").withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.wrap_angle(a.rounded(out), "wind_direction_avg")


@query(
    "stream_closed_hours",
    f"""WITH {a.READINGS}
    SELECT region, date_trunc('hour', "timestamp") AS "timestamp",
           {a.sql_wrapped(a.sql_circular_mean('wind_direction'), 'wind_direction_avg')},
           {a.sql_round(a.sql_circular_std('wind_direction'), 'wind_direction_std')}, count(*) AS reading_count
    FROM valid WHERE date_trunc('hour', "timestamp") + INTERVAL 1 HOUR <= (SELECT max("timestamp") FROM valid) - INTERVAL 2 HOUR
    GROUP BY 1, 2""",
)
def stream_closed_hours(spark, sf_dir):
    """Batches in falling order of time: all but the first are late.  Hours are closed by the watermark, corrected by what
    came late, and never rewritten."""
    root = work_path(spark, "closed_hours")
    stream = valid_directions(_event_stream(spark, sf_dir), "wind_direction").select("event_id", "region", "timestamp", "wind_direction")
    append_to_log(stream, root, f"{root}/log").awaitTermination()
    settings = {"key": ["event_id"], "value": "wind_direction", "name": "wind_direction", "circular": True}
    close_hours(spark, root, f"{root}/close", stream.schema, **settings).awaitTermination()
    correct_hours(spark, root, stream.schema, **settings)
    out = read_hours(spark, root).withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.wrap_angle(a.rounded(out), "wind_direction_avg")


@query(
    "stream_incremental_ingest",
    f"""WITH {a.READINGS} SELECT event_id, station_id, "timestamp", {a.sql_round('wind_speed', 'wind_speed')} FROM readings""",
)
def stream_incremental_ingest(spark, sf_dir):
    """Ingest late files and, from a fresh checkpoint, everything again: nothing is lost or doubled."""
    root = work_path(spark, "stream_ingest")
    spec = TableSpec("bronze", 1, ("event_id", "timestamp"), partition_by=())
    readings = _event_stream(spark, sf_dir).select("event_id", "station_id", "timestamp", "wind_speed")
    for run in range(2):
        keep_readings(readings, spec, root, f"{root}/checkpoint-{run}").awaitTermination()
    out = read_table(spark, root, "bronze")
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "group_apply",
    f"""WITH {a.READINGS}, d AS (
      SELECT station_id, strftime("timestamp", '%Y-%m') AS month, wind_speed FROM readings)
    SELECT station_id, month, {a.sql_round('max(wind_speed) - min(wind_speed)', 'spread')} FROM d GROUP BY 1, 2""",
)
def group_apply(spark, sf_dir):
    """A caller's pandas function per station and month.

    Hourly extremes are aggregated in Spark first, so that a group has 744 rows at most.
    """
    hours = a.readings(spark, sf_dir).groupBy(
        "station_id", F.date_format("timestamp", "yyyy-MM").alias("month"), hour_start(F.col("timestamp")).alias("hour")
    ).agg(F.min("wind_speed").alias("low"), F.max("wind_speed").alias("high"))

    def spread(group: pd.DataFrame) -> pd.DataFrame:
        head = group[["station_id", "month"]].head(1)
        return head.assign(spread=group["high"].max() - group["low"].min())

    return a.rounded(apply_to_groups(hours, ["station_id", "month"], spread, "station_id string, month string, spread double"))


@query(
    "group_lambda_aggregate",
    f"""WITH {a.READINGS}, h AS (
      SELECT region, date_trunc('hour', "timestamp") AS h, avg(wind_speed) AS w FROM located GROUP BY 1, 2)
    SELECT region, CAST(h AS DATE) AS day, {a.sql_round('median(w)', 'median')} FROM h GROUP BY 1, 2""",
)
def group_lambda_aggregate(spark, sf_dir):
    """A caller's aggregate over the (at most 24) hourly means of a region's day."""
    hours = a.located(spark, sf_dir).groupBy(
        "region", F.to_date("timestamp").alias("day"), F.hour("timestamp").alias("hour")
    ).agg(F.avg("wind_speed").alias("w"))
    median = group_aggregate(lambda values: float(values.median()))
    return a.rounded(hours.groupBy("region", "day").agg(median("w").alias("median")))
