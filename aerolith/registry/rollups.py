"""Rollups (A1-A18), circular statistics (C1, C2), nearest region."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions.airquality import concentration_to_index, index_band
from aerolith.functions.geo import nearest_region
from aerolith.operators import rollup
from aerolith.operators.clean import coerce_numeric, rename, valid_directions
from aerolith.operators.joins import attach_coordinates
from aerolith.registry import query
from aerolith.registry import adapters as a

FIRST = 'arg_min(latitude, "timestamp") AS latitude, arg_min(longitude, "timestamp") AS longitude'
HOUR = "date_trunc('hour', \"timestamp\")"
DAY = "date_trunc('day', \"timestamp\")"
SG_DAY = "date_trunc('day', \"timestamp\" + INTERVAL 8 HOURS)"


def _first_rounded() -> str:
    return ", ".join(a.sql_round(f'arg_min({c}, "timestamp")', c) for c in ("latitude", "longitude"))


def _circular(mean: str, std: str, x: str = "wind_direction") -> str:
    return f"{a.sql_wrapped(a.sql_circular_mean(x), mean)}, {a.sql_round(a.sql_circular_std(x), std)}"


def hourly_circular(spark, sf_dir):
    r = coerce_numeric(a.located(spark, sf_dir), "value_text")
    r = valid_directions(r, "wind_direction").filter(F.col("region").isNotNull())
    out = rollup.region_hour_circular(r, "wind_direction")
    return a.wrap_angle(a.rounded(out), "wind_direction_avg")


query(
    "hourly_circular_by_region",
    f"""WITH {a.READINGS}
    SELECT region, {HOUR} AS "timestamp", {_circular('wind_direction_avg', 'wind_direction_std')},
           count(*) AS reading_count, {_first_rounded()}
    FROM valid WHERE TRY_CAST(value_text AS DOUBLE) IS NOT NULL AND region IS NOT NULL GROUP BY 1, 2""",
)(hourly_circular)


@query(
    "daily_circular_by_region",
    f"""WITH {a.READINGS}
    SELECT region, {SG_DAY} AS "timestamp", {_circular('wind_direction_avg_mean', 'wind_direction_avg_std')},
           {a.sql_round('min(wind_direction)', 'wind_direction_avg_min')},
           {a.sql_round('max(wind_direction)', 'wind_direction_avg_max')}, {_first_rounded()}
    FROM valid GROUP BY 1, 2""",
)
def daily_circular(spark, sf_dir):
    r = valid_directions(a.located(spark, sf_dir), "wind_direction")
    out = rollup.region_day_circular(r, "wind_direction", tz="Asia/Singapore", source_tz="UTC")
    return a.wrap_angle(a.rounded(out), "wind_direction_avg_mean")


@query(
    "hourly_scalar_by_region",
    f"""WITH {a.READINGS}
    SELECT region, {HOUR} AS "timestamp", {a.sql_round('avg(wind_speed)', 'wind_speed_avg')},
           count(wind_speed) AS reading_count, {_first_rounded()}
    FROM located GROUP BY 1, 2""",
)
def hourly_scalar(spark, sf_dir):
    return a.rounded(rollup.region_hour_scalar(a.located(spark, sf_dir), "wind_speed"))


def _daily_scalar_sql(day: str, value: str, name: str) -> str:
    return f"""WITH {a.READINGS}
    SELECT region, {day} AS "timestamp", {a.sql_round(f'avg({value})', f'{name}_mean')},
           {a.sql_round(f'min({value})', f'{name}_min')}, {a.sql_round(f'max({value})', f'{name}_max')},
           {a.sql_round(f'stddev_samp({value})', f'{name}_std')}, {_first_rounded()}
    FROM located GROUP BY 1, 2"""


@query("daily_scalar_by_region", _daily_scalar_sql(SG_DAY, "wind_speed", "wind_speed_avg"))
def daily_scalar(spark, sf_dir):
    return a.rounded(
        rollup.region_day_scalar(a.located(spark, sf_dir), "wind_speed", tz="Asia/Singapore", source_tz="UTC")
    )


@query("forecast_daily_scalar", _daily_scalar_sql(DAY, "value", "air_temperature_avg"))
def forecast_daily_scalar(spark, sf_dir):
    return a.rounded(rollup.region_day_scalar(a.located(spark, sf_dir), "value", "air_temperature_avg"))


_FORECAST_HOURS = f"""hours AS (
  SELECT region, {HOUR} AS "timestamp", {a.sql_circular_mean('wind_direction')} AS wind_direction_avg,
         arg_min(latitude, "timestamp") AS latitude, arg_min(longitude, "timestamp") AS longitude
  FROM valid GROUP BY 1, 2)"""


@query(
    "forecast_daily_angular",
    f"""WITH {a.READINGS}, {_FORECAST_HOURS}
    SELECT region, {DAY} AS "timestamp",
           {_circular('wind_direction_avg_mean', 'wind_direction_avg_std', 'wind_direction_avg')},
           {a.sql_round('min(wind_direction_avg)', 'wind_direction_avg_min')},
           {a.sql_round('max(wind_direction_avg)', 'wind_direction_avg_max')}, {_first_rounded()}
    FROM hours GROUP BY 1, 2""",
)
def forecast_daily_angular(spark, sf_dir):
    hours = rollup.region_hour_circular(valid_directions(a.located(spark, sf_dir), "wind_direction"), "wind_direction")
    out = rollup.region_day_circular(hours, "wind_direction_avg", "wind_direction_avg")
    return a.wrap_angle(a.rounded(out), "wind_direction_avg_mean")


@query(
    "global_circular_std",
    f"""WITH {a.READINGS}, {_FORECAST_HOURS}
    SELECT region, "timestamp", {a.sql_wrapped('wind_direction_avg', 'wind_direction_avg')},
           (SELECT {a.sql_round(a.sql_circular_std('wind_direction_avg'), 's')} FROM hours) AS wind_direction_std
    FROM hours""",
)
def global_circular_std(spark, sf_dir):
    hours = rollup.region_hour_circular(valid_directions(a.located(spark, sf_dir), "wind_direction"), "wind_direction")
    out = rollup.with_overall_spread(hours.select("region", "timestamp", "wind_direction_avg"), "wind_direction_avg")
    return a.wrap_angle(a.rounded(out), "wind_direction_avg")


@query(
    "hour_states_to_days",
    _daily_scalar_sql(SG_DAY, "wind_speed", "wind_speed_avg"),
)
def hour_states_to_days(spark, sf_dir):
    states = rollup.hour_states(a.located(spark, sf_dir), "wind_speed", tz="Asia/Singapore", source_tz="UTC")
    return a.rounded(rollup.days_from_states(states, "wind_speed"))


@query(
    "hour_states_to_days_circular",
    f"""WITH {a.READINGS}
    SELECT region, {SG_DAY} AS "timestamp", {_circular('wind_direction_avg_mean', 'wind_direction_avg_std')},
           {a.sql_round('min(wind_direction)', 'wind_direction_avg_min')},
           {a.sql_round('max(wind_direction)', 'wind_direction_avg_max')}, {_first_rounded()}
    FROM valid GROUP BY 1, 2""",
)
def hour_states_to_days_circular(spark, sf_dir):
    r = valid_directions(a.located(spark, sf_dir), "wind_direction")
    states = rollup.hour_states(r, "wind_direction", tz="Asia/Singapore", source_tz="UTC", circular=True)
    return a.wrap_angle(a.rounded(rollup.days_from_states(states, "wind_direction", True)), "wind_direction_avg_mean")


@query(
    "station_hour_rollup",
    f"""WITH {a.READINGS}
    SELECT station_id AS station_name, {HOUR} AS "timestamp", {a.sql_round('avg(wind_speed)', 'wind_speed_avg')},
           count(*) AS reading_count, {_first_rounded()}, max("timestamp") AS last_update
    FROM readings GROUP BY 1, 2""",
)
def station_hour_rollup(spark, sf_dir):
    r = rename(a.readings(spark, sf_dir), {"station_id": "station_name"}).withColumn("updated", F.col("timestamp"))
    return a.rounded(rollup.station_hour_scalar(r, "wind_speed", "wind_speed", update="updated"))


@query(
    "station_id_hour_rollup",
    f"""WITH {a.READINGS}
    SELECT station_id, {HOUR} AS "timestamp", {a.sql_round('avg(wind_speed)', 'wind_speed_avg')},
           count(*) AS reading_count
    FROM readings GROUP BY 1, 2""",
)
def station_id_hour_rollup(spark, sf_dir):
    r = a.readings(spark, sf_dir).drop("latitude", "longitude")
    return a.rounded(rollup.station_hour_scalar(r, "wind_speed", "wind_speed", station="station_id"))


@query(
    "station_hour_circular",
    f"""WITH {a.READINGS}
    SELECT station_id, {HOUR} AS "timestamp", {_circular('wind_direction_avg', 'wind_direction_std')},
           count(*) AS reading_count, {_first_rounded()}, max("timestamp") AS last_update
    FROM valid GROUP BY 1, 2""",
)
def station_hour_circular(spark, sf_dir):
    r = valid_directions(a.readings(spark, sf_dir), "wind_direction").withColumn("updated", F.col("timestamp"))
    out = rollup.station_hour_circular(r, "wind_direction", "wind_direction", station="station_id", update="updated")
    return a.wrap_angle(a.rounded(out), "wind_direction_avg")


_SUMMARY = """min("timestamp") AS start_date, max("timestamp") AS end_date, count(*) AS total_hours"""


@query(
    "station_summary_scalar",
    f"""WITH {a.READINGS}, hours AS (
      SELECT station_id, {HOUR} AS "timestamp", avg(wind_speed) AS wind_speed_avg, {FIRST} FROM readings GROUP BY 1, 2)
    SELECT station_id, {_SUMMARY}, {_first_rounded()}, {a.sql_round('avg(wind_speed_avg)', 'mean')},
           {a.sql_round('min(wind_speed_avg)', 'min')}, {a.sql_round('max(wind_speed_avg)', 'max')}
    FROM hours GROUP BY 1""",
)
def station_summary_scalar(spark, sf_dir):
    hours = rollup.station_hour_scalar(a.readings(spark, sf_dir), "wind_speed", "wind_speed", station="station_id")
    return a.rounded(rollup.station_summary_scalar(hours, "wind_speed_avg", station="station_id"))


@query(
    "station_summary_circular",
    f"""WITH {a.READINGS}, hours AS (
      SELECT station_id, {HOUR} AS "timestamp", {a.sql_circular_mean('wind_direction')} AS m,
             {a.sql_circular_std('wind_direction')} AS s, {FIRST} FROM valid GROUP BY 1, 2)
    SELECT station_id, {_SUMMARY}, {_first_rounded()}, {a.sql_wrapped(a.sql_circular_mean('m'), 'overall_mean')},
           {a.sql_round('avg(s)', 'mean_spread')}
    FROM hours GROUP BY 1""",
)
def station_summary_circular(spark, sf_dir):
    r = valid_directions(a.readings(spark, sf_dir), "wind_direction")
    hours = rollup.station_hour_circular(r, "wind_direction", "wind_direction", station="station_id")
    out = rollup.station_summary_circular(hours, "wind_direction_avg", "wind_direction_std", station="station_id")
    return a.wrap_angle(a.rounded(out), "overall_mean")


@query(
    "daily_linear_with_coords",
    f"""WITH {a.READINGS},
    hours AS (SELECT region, {HOUR} AS "timestamp", avg(wind_speed) AS wind_speed_avg FROM located GROUP BY 1, 2),
    days AS (SELECT region, {DAY} AS "timestamp", avg(wind_speed_avg) AS m, max(wind_speed_avg) AS hi,
                    min(wind_speed_avg) AS lo, stddev_samp(wind_speed_avg) AS s FROM hours GROUP BY 1, 2),
    coords AS (SELECT region, {FIRST} FROM located GROUP BY 1)
    SELECT d.region, d."timestamp", {a.sql_round('m', 'wind_speed_avg_mean')}, {a.sql_round('hi', 'wind_speed_avg_max')},
           {a.sql_round('lo', 'wind_speed_avg_min')}, {a.sql_round('s', 'wind_speed_avg_std')},
           {a.sql_round('latitude', 'latitude')}, {a.sql_round('longitude', 'longitude')}
    FROM days d LEFT JOIN coords c ON d.region = c.region""",
)
def daily_linear_with_coords(spark, sf_dir):
    r = a.located(spark, sf_dir)
    hours = rollup.region_hour_scalar(r, "wind_speed")
    days = rollup.region_day_linear(hours, "wind_speed_avg")
    return a.rounded(attach_coordinates(days, rollup.region_coordinates(r)))


# The SQL's own numbers: the published breakpoints of concentration and index.
_SQL_POINTS = ((0.0, 0.0), (12.0, 50.0), (35.5, 100.0), (55.5, 150.0), (150.5, 200.0), (250.5, 300.0))


def index_sql(x: str) -> str:
    whole = f"floor({x})"
    whens = " ".join(
        f"WHEN {whole} <= {x1}e0 THEN CAST(floor({y0}e0 + ({whole} - {x0}e0) * {y1 - y0}e0 / {x1 - x0}e0 + 0.5e0) AS INTEGER)"
        for (x0, y0), (x1, y1) in zip(_SQL_POINTS, _SQL_POINTS[1:])
    )
    return f"CASE WHEN {whole} < 0 OR {whole} >= 200 THEN NULL {whens} END"


@query(
    "daily_aqi",
    f"""SELECT event_type AS region, date_trunc('day', ts + INTERVAL 8 HOURS) AS "timestamp",
           round_even(avg({index_sql('value')}), 0) AS pm25
    FROM events GROUP BY 1, 2""",
)
def daily_aqi(spark, sf_dir):
    r = a.readings(spark, sf_dir).withColumn("region", F.col("event_type"))
    return rollup.daily_index(r, "value", tz="Asia/Singapore", source_tz="UTC")


@query(
    "aqi_category",
    f"""WITH x AS (SELECT event_id, value, {index_sql('value')} AS aqi FROM events)
    SELECT event_id, value, aqi, CASE WHEN aqi < 50 THEN 'Good' WHEN aqi < 100 THEN 'Moderate' WHEN aqi < 150 THEN 'Unhealthy for Some'
      WHEN aqi < 200 THEN 'Unhealthy' WHEN aqi < 300 THEN 'Very Unhealthy' WHEN aqi IS NOT NULL THEN 'Hazardous' END AS band FROM x""",
)
def aqi_category(spark, sf_dir):
    e = a.table(spark, sf_dir, "events").select("event_id", "value")
    indexed = e.withColumn("aqi", concentration_to_index(F.col("value")))
    return indexed.withColumn("band", index_band(F.col("aqi")))


@query(
    "dominant_direction_day",
    f"""WITH {a.READINGS}, w AS (
      SELECT {DAY} AS day, value, wind_speed, CAST(round(wind_direction / 10) * 10 AS INTEGER) AS direction FROM readings),
    counts AS (SELECT day, direction, count(*) AS n FROM w GROUP BY 1, 2),
    top AS (SELECT day, direction FROM counts QUALIFY row_number() OVER (PARTITION BY day ORDER BY n DESC, direction) = 1),
    m AS (SELECT day, avg(wind_speed) AS t, sum(value) AS p, max(wind_speed) AS s FROM w GROUP BY 1)
    SELECT m.day, {a.sql_round('t', 'temperature_2m_mean')}, {a.sql_round('p', 'precipitation_sum')},
           {a.sql_round('s', 'wind_speed_10m_max')}, top.direction AS wind_direction_10m_dominant
    FROM m JOIN top ON m.day = top.day""",
)
def dominant_direction_day(spark, sf_dir):
    r = a.readings(spark, sf_dir).select(
        F.to_date("timestamp").cast("timestamp_ntz").alias("day"), "value", "wind_speed",
        (F.round(F.col("wind_direction") / 10) * 10).cast("int").alias("direction"),
    )
    return a.rounded(rollup.weather_day(r, ["day"], "wind_speed", "value", "wind_speed", "direction"))


@query(
    "station_distinct_and_range",
    f"""WITH {a.READINGS}, x AS (
      SELECT region, count(DISTINCT station_id) AS distinct_station_id, CAST(min("timestamp") AS DATE) AS first_day,
             CAST(max("timestamp") AS DATE) AS last_day, count(*) AS "rows" FROM located GROUP BY 1)
    SELECT * FROM x""",
)
def station_distinct_and_range(spark, sf_dir):
    r = a.located(spark, sf_dir)
    return rollup.distinct_count(r, "station_id", ["region"]).join(rollup.period(r, ["region"]), "region")


@query(
    "nearest_region",
    f"""WITH {a.READINGS} SELECT DISTINCT user_id, {a.sql_round('latitude', 'latitude')},
       {a.sql_round('longitude', 'longitude')}, region FROM located""",
)
def nearest(spark, sf_dir):
    return a.rounded(a.located(spark, sf_dir).select("user_id", "latitude", "longitude", "region")).distinct()


@query(
    "nearest_region_unmatched",
    f"""WITH {a.READINGS},
    s AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE latitude END AS latitude, longitude FROM readings)
    SELECT event_id, {a.sql_region()} AS region, {a.sql_region("'central'")} AS region_or_first FROM s""",
)
def nearest_unmatched(spark, sf_dir):
    latitude = F.when(F.col("user_id") % 3 != 0, F.col("latitude"))
    longitude = F.col("longitude")
    return a.readings(spark, sf_dir).select(
        "event_id",
        nearest_region(latitude, longitude).alias("region"),
        nearest_region(latitude, longitude, unmatched="first").alias("region_or_first"),
    )
