"""Projections, predicates, scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions import text, times
from aerolith.functions.airquality import concentration_to_index
from aerolith.functions.angles import wind_u, wind_v
from aerolith.operators import clean
from aerolith.registry import query
from aerolith.registry import adapters as a


@query(
    "clean_numeric",
    f"""WITH {a.READINGS}
    SELECT event_id, station_id, {a.sql_round('TRY_CAST(value_text AS DOUBLE)', 'value_text')} FROM readings
    WHERE TRY_CAST(value_text AS DOUBLE) IS NOT NULL""",
)
def clean_numeric(spark, sf_dir):
    r = a.readings(spark, sf_dir).select("event_id", "station_id", "value_text")
    return a.rounded(clean.coerce_numeric(r, "value_text"))


@query(
    "validity_report",
    f"""WITH {a.READINGS}, x AS (
      SELECT CASE WHEN event_id % 89 = 0 THEN NULL ELSE wind_direction END AS d FROM readings)
    SELECT count(*) AS "rows", count(*) FILTER (d IS NULL) AS not_numeric,
           count(*) FILTER (d < 0 OR d > 360) AS out_of_range, count(*) FILTER (d BETWEEN 0 AND 360) AS kept FROM x""",
)
def validity_report(spark, sf_dir):
    r = a.readings(spark, sf_dir).select(
        F.when(F.col("event_id") % 89 == 0, "bad").otherwise(F.col("wind_direction").cast("string")).alias("d")
    )
    return clean.validity_report(r, "d")


@query(
    "region_filter_project",
    f"""WITH {a.READINGS}
    SELECT event_id, "timestamp", region, 'Singapore' AS city, {a.sql_round('wind_speed', 'wind_speed')} FROM located
    WHERE region = 'west' AND "timestamp" >= TIMESTAMP '2024-01-08' AND "timestamp" < TIMESTAMP '2024-01-22'""",
)
def region_filter_project(spark, sf_dir):
    r = clean.in_region(a.located(spark, sf_dir), "west")
    r = clean.before(clean.since(r, "timestamp", "2024-01-08"), "timestamp", "2024-01-22")
    picked = r.select("event_id", "timestamp", "region", F.lit("Singapore").alias("city"), "wind_speed")
    return a.rounded(picked).orderBy("timestamp")


@query(
    "swap_and_drop_columns",
    f"""WITH {a.READINGS} SELECT event_id, event_type AS station_id, station_id AS event_type,
       {a.sql_round('value', 'value')} FROM readings""",
)
def swap_and_drop_columns(spark, sf_dir):
    r = clean.rename(a.readings(spark, sf_dir), {"station_id": "event_type", "event_type": "station_id"})
    unwanted = ["timestamp", "user_id", "props", "wind_direction", "wind_speed", "value_text", "latitude", "longitude"]
    return a.rounded(clean.drop_existing(r, [*unwanted, "never_there"]))


@query(
    "align_model_features",
    f"""WITH {a.READINGS}
    SELECT event_id, {a.sql_round('longitude', 'longitude')}, NULL::DOUBLE AS humidity,
           {a.sql_round('value', 'value')}, CAST(user_id AS DOUBLE) AS user_id FROM readings""",
)
def align_model_features(spark, sf_dir):
    aligned = clean.align_features(
        a.readings(spark, sf_dir), ["longitude", "humidity", "value", "user_id"], keep=["event_id"]
    )
    return a.rounded(aligned)


@query(
    "complete_cases_and_defaults",
    f"""WITH {a.READINGS}, x AS (
      SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE wind_speed END AS speed,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE wind_direction END AS direction FROM readings)
    SELECT event_id, {a.sql_round('speed', 'speed')}, {a.sql_round('coalesce(direction, 0)', 'direction')}
    FROM x WHERE speed IS NOT NULL""",
)
def complete_cases_and_defaults(spark, sf_dir):
    r = a.readings(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 5 != 0, F.col("wind_speed")).alias("speed"),
        F.when(F.col("event_id") % 7 != 0, F.col("wind_direction")).alias("direction"),
    )
    return a.rounded(clean.complete_cases(r.fillna(0.0, subset=["direction"])))


@query(
    "numeric_columns_only",
    """SELECT s_suppkey, s_nationkey, round(s_acctbal, 6) + 0.0 AS s_acctbal FROM supplier""",
)
def numeric_columns_only(spark, sf_dir):
    s = a.table(spark, sf_dir, "supplier")
    return a.rounded(s.select(*clean.numeric_columns(s)))


@query(
    "typed_columns",
    """SELECT event_id, CAST(value AS REAL)::DOUBLE AS value32, CAST(event_id % 100 AS TINYINT) AS small,
       event_id % 2 = 0 AS even, CAST(user_id AS VARCHAR) AS user FROM events""",
)
def typed_columns(spark, sf_dir):
    return a.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("value").cast("float").cast("double").alias("value32"),
        (F.col("event_id") % 100).cast("tinyint").alias("small"),
        (F.col("event_id") % 2 == 0).alias("even"),
        F.col("user_id").cast("string").alias("user"),
    )


@query(
    "time_scalars",
    """SELECT event_id, ts + INTERVAL 8 HOURS AS local_time, CAST(ts + INTERVAL 8 HOURS AS DATE) AS local_day,
       date_trunc('hour', ts) AS hour_start, CAST(CAST(ts + INTERVAL 8 HOURS AS DATE) AS TIMESTAMP) AS day_timestamp,
       ts - INTERVAL 7 DAYS AS week_earlier, ts + INTERVAL 1 DAYS AS day_later,
       strftime(ts, '%Y-%m-%d') AS formatted, make_timestamp(CAST(event_id AS BIGINT) * 1000000) AS from_seconds,
       date_trunc('hour', ts) - INTERVAL 8 HOURS AS back_to_utc, ts AS parsed FROM events""",
)
def time_scalars(spark, sf_dir):
    ts = F.col("ts")
    zone, source = "Asia/Singapore", "UTC"
    iso = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    utc = lambda c: times.local_clock(c, "UTC")
    return a.table(spark, sf_dir, "events").select(
        "event_id",
        times.local_clock(ts, zone, source).alias("local_time"),
        times.local_day(ts, zone, source).alias("local_day"),
        times.hour_start(ts).alias("hour_start"),
        times.day_timestamp(times.local_day(ts, zone, source)).alias("day_timestamp"),
        times.minus_days(ts, 7).alias("week_earlier"),
        times.plus_days(ts, 1).alias("day_later"),
        times.format_day(ts).alias("formatted"),
        utc(times.from_unix_seconds(F.col("event_id"))).alias("from_seconds"),
        times.to_instant(times.hour_start(ts), zone).alias("back_to_utc"),
        utc(times.parse_instant(iso)).alias("parsed"),
    )


@query(
    "name_scalars",
    """SELECT s_suppkey, translate(s_name || ' a/b\\c', ' /\\', '___') AS file_name,
       lower(s_name) LIKE '%not found%' AS missing, split_part(s_name, '#', 2) AS last, trim('  ' || s_name || ' ') AS trimmed,
       upper(s_name[1]) || lower(s_name[2:]) AS street FROM supplier""",
)
def name_scalars(spark, sf_dir):
    name = F.col("s_name")
    return a.table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        text.safe_name(F.concat(name, F.lit(" a/b\\c"))).alias("file_name"),
        text.mentions_missing_data(name).alias("missing"),
        text.last_part(name, "#").alias("last"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        text.street_name(name).alias("street"),
    )


@query(
    "wind_components",
    f"""WITH {a.READINGS} SELECT event_id, {a.sql_round('-sin(radians(wind_direction))', 'u')},
       {a.sql_round('-cos(radians(wind_direction))', 'v')} FROM readings""",
)
def wind_components(spark, sf_dir):
    d = F.col("wind_direction")
    return a.rounded(a.readings(spark, sf_dir).select("event_id", wind_u(d).alias("u"), wind_v(d).alias("v")))


@query(
    "index_points",
    """WITH c AS (SELECT event_id, CAST(floor(value) AS INTEGER) AS x FROM events)
    SELECT event_id, CASE
      WHEN x < 0 OR x > 199 THEN NULL
      WHEN x < 12 THEN CAST(floor(x * 50e0 / 12e0 + 0.5e0) AS INTEGER)
      WHEN x < 35.5e0 THEN CAST(floor(50e0 + (x - 12) * 50e0 / 23.5e0 + 0.5e0) AS INTEGER)
      WHEN x < 55.5e0 THEN CAST(floor(100e0 + (x - 35.5e0) * 50e0 / 20e0 + 0.5e0) AS INTEGER)
      WHEN x < 150.5e0 THEN CAST(floor(150e0 + (x - 55.5e0) * 50e0 / 95e0 + 0.5e0) AS INTEGER)
      ELSE CAST(floor(200e0 + (x - 150.5e0) * 100e0 / 100e0 + 0.5e0) AS INTEGER) END AS index
    FROM c""",
)
def index_points(spark, sf_dir):
    """Index of every reading; the SQL has the published breakpoints as numbers of its own."""
    return a.table(spark, sf_dir, "events").select("event_id", concentration_to_index(F.col("value")).alias("index"))
