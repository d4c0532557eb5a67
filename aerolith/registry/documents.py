"""Nested documents (S1, S2, S7-S9, P17-P19), built from the tables as JSON text and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions.times import hour_start, local_clock
from aerolith.operators.merge import merge_station_metadata
from aerolith.registry import query
from aerolith.registry import adapters as a
from aerolith.registry.rollups import index_sql
from aerolith.sources import landing

PAGE_ROWS = 200
# Event types in the role of regions; "signup" plays the national value that is no region.
ROLES = {"click": "east", "error": "west", "purchase": "north", "view": "south", "signup": "national"}
_ROLE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ROLES.items()) + " END"


def _role():
    whens = None
    for event_type, region in ROLES.items():
        hit = F.col("event_type") == event_type
        whens = F.when(hit, region) if whens is None else whens.when(hit, region)
    return whens


def _iso(ts):
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def station_pages(spark, sf_dir):
    """Pages of at most PAGE_ROWS readings and their stations, as JSON documents."""
    r = a.readings(spark, sf_dir)
    reading = F.struct(
        _iso(F.col("timestamp")).alias("timestamp"),
        F.array(F.struct(F.col("station_id").alias("stationId"), F.col("value_text").alias("value"))).alias("data"),
    )
    station = F.struct(
        F.col("station_id").alias("id"), F.col("event_type").alias("deviceId"), F.col("props").alias("name"),
        F.struct("latitude", "longitude").alias("location"),
    )
    pages = r.groupBy(F.floor(F.col("event_id") / PAGE_ROWS).alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("event_id", reading.alias("r")))).alias("rs"),
        F.sort_array(F.collect_list(F.struct("event_id", station.alias("s")))).alias("ss"),
    )
    # Even pages call the list "readings", odd ones "items": both names occur.
    readings = F.transform("rs", lambda x: x["r"])
    even = F.col("page") % 2 == 0
    data = F.struct(
        F.transform("ss", lambda x: x["s"]).alias("stations"),
        F.when(even, readings).alias("readings"),
        F.when(~even, readings).alias("items"),
    )
    text = F.to_json(F.struct(F.lit(0).alias("code"), data.alias("data")))
    return pages.select("page", F.from_json(text, schemas.STATION_PAGE).alias("d")).select("page", "d.*")


@query(
    "nested_readings_explode",
    f"""WITH {a.READINGS} SELECT "timestamp", station_id,
       {a.sql_round('TRY_CAST(value_text AS DOUBLE)', 'value')} FROM readings""",
)
def nested_readings_explode(spark, sf_dir):
    out = landing.station_readings(station_pages(spark, sf_dir))
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "station_mentions_merge",
    f"""SELECT 'S' || user_id AS id, props AS name, event_type AS device_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id // {PAGE_ROWS} % 7 DESC, event_id) = 1""",
)
def station_mentions_merge(spark, sf_dir):
    pages = station_pages(spark, sf_dir)
    mentions = landing.station_mentions(pages, F.col("page") % 7, F.col("page"))
    return merge_station_metadata(mentions, fields=("name", "device_id"))


def region_pages(spark, sf_dir):
    """One document per hour with a map region -> mean value (at most 5 entries)."""
    hours = a.readings(spark, sf_dir).groupBy(hour_start(F.col("timestamp")).alias("h"), _role().alias("role"))
    means = hours.agg(F.round(F.avg("value"), 4).cast("string").alias("v"))
    items = means.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("role", "v"))).alias("m"))
    item = F.struct(
        F.date_format("h", "yyyy-MM-dd").alias("date"), _iso(F.col("h")).alias("timestamp"),
        _iso(F.col("h")).alias("updatedTimestamp"), F.struct(F.col("m").alias("pm25_one_hourly")).alias("readings"),
    )
    text = F.to_json(F.struct(F.lit(0).alias("code"), F.struct(F.array(item).alias("items")).alias("data")))
    return items.select(F.from_json(text, schemas.REGION_PAGE).alias("d")).select("d.*")


_REGION_HOURS = f"""hours AS (SELECT date_trunc('hour', ts) AS "timestamp", {_ROLE_SQL} AS region,
  round(avg(value), 4) AS pm25 FROM events GROUP BY 1, 2)"""


@query(
    "map_readings_explode",
    f"""WITH {_REGION_HOURS} SELECT "timestamp", region, {a.sql_round('pm25', 'pm25')} FROM hours WHERE region <> 'national'""",
)
def map_readings_explode(spark, sf_dir):
    out = landing.region_readings(region_pages(spark, sf_dir))
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "unpivot_regions",
    f"""WITH {_REGION_HOURS} SELECT "timestamp", CAST("timestamp" AS DATE) AS date, region,
       {a.sql_round('pm25', 'pm25')} FROM hours""",
)
def unpivot_regions(spark, sf_dir):
    wide = landing.region_readings_wide(region_pages(spark, sf_dir))
    wide = wide.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    return a.rounded(landing.wide_to_long(wide, regions=landing.WIDE_REGIONS, as_index=False))


@query(
    "unpivot_regions_as_index",
    f"""WITH {_REGION_HOURS} SELECT "timestamp", CAST("timestamp" AS DATE) AS date, region, {index_sql('pm25')} AS pm25
    FROM hours WHERE region <> 'national'""",
)
def unpivot_regions_as_index(spark, sf_dir):
    wide = landing.region_readings_wide(region_pages(spark, sf_dir))
    return landing.wide_to_long(wide.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


@query(
    "parallel_arrays_explode",
    f"""WITH {a.DAILY} SELECT region, CAST("timestamp" AS DATE) AS date, {a.sql_round('air_temperature_avg_mean', 'temperature_2m_mean')},
       {a.sql_round('precipitation_sum', 'precipitation_sum')}, {a.sql_round('wind_speed_avg_mean', 'wind_speed_10m_max')},
       {a.sql_round('wind_direction_avg_mean', 'wind_direction_10m_dominant')} FROM weather""",
)
def parallel_arrays_explode(spark, sf_dir):
    """Weather documents with one array per measure (a month long), back to rows."""
    fields = {
        "temperature_2m_mean": "air_temperature_avg_mean", "precipitation_sum": "precipitation_sum",
        "wind_speed_10m_max": "wind_speed_avg_mean", "wind_direction_10m_dominant": "wind_direction_avg_mean",
    }
    day = F.struct(F.date_format("timestamp", "yyyy-MM-dd").alias("time"), *[F.col(c).alias(n) for n, c in fields.items()])
    months = a.weather(spark, sf_dir).groupBy("region", F.date_format("timestamp", "yyyy-MM").alias("month"))
    arrays = months.agg(F.sort_array(F.collect_list(day)).alias("d"))
    daily = F.struct(*[F.col("d")[n].alias(n) for n in ("time", *fields)])
    text = F.to_json(F.struct(daily.alias("daily")))
    documents = arrays.select("region", F.from_json(text, schemas.WEATHER_ARRAYS).alias("w")).select("region", "w.*")
    rows = landing.zip_arrays(documents, "daily", ("time", *fields), keep=["region"])
    return a.rounded(rows.select("region", F.to_date("time").alias("date"), *fields))


@query(
    "time_axis_expand",
    f"""WITH b AS (
      SELECT vec_id, ['central', 'north', 'south', 'east', 'west'][label % 5 + 1] AS region, embedding,
             unnest(generate_series(1, len(embedding))) AS i FROM embeddings)
    SELECT region, make_timestamp((vec_id * 1000000 + (i - 1) * 3600) * 1000000) AS "timestamp",
           {a.sql_round('CAST(embedding[i] AS DOUBLE)', 'air_temperature_avg')},
           {a.sql_round('CAST(embedding[i] AS DOUBLE) * 2', 'wind_speed_avg')},
           CASE WHEN i <= 10 THEN round(CAST(embedding[i] AS DOUBLE), 6) + 0.0 END AS wind_direction_avg, CAST(60 AS BIGINT) AS reading_count
    FROM b""",
)
def time_axis_expand(spark, sf_dir):
    """Each vector as a forecast block: start, end, hourly interval and value arrays."""
    e = a.table(spark, sf_dir, "embeddings")
    values = F.transform("embedding", lambda x: x.cast("double"))
    start = F.col("vec_id") * 1_000_000
    blocks = e.select(
        F.element_at(F.array(*[F.lit(r) for r in ("central", "north", "south", "east", "west")]), F.col("label") % 5 + 1)
        .alias("region"),
        start.alias("start_s"),
        (start + F.size("embedding") * 3600).alias("end_s"),
        F.lit(3600).cast("bigint").alias("interval_s"),
        values.alias("temperature_2m"),
        F.transform(values, lambda x: x * 2).alias("wind_speed_10m"),
        F.slice(values, 1, 10).alias("wind_direction_10m"),
    )
    out = landing.forecast_hours(blocks).drop("latitude", "longitude")
    return a.rounded(out.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC")))


def sensor_feeds(spark, sf_dir):
    e = a.table(spark, sf_dir, "events")
    feed = F.struct(
        F.when(F.col("event_id") % 11 == 0, "error").otherwise("ok").alias("status"),
        F.col("user_id").alias("sensor_id"),
        F.struct(
            F.floor("value").cast("int").alias("aqi"), F.col("event_type").alias("dominentpol"),
            F.struct(_iso(F.col("ts")).alias("iso")).alias("time"),
            F.map_from_arrays(
                F.array(_pollutant(), F.lit("k")),
                F.array(F.struct(F.col("value").alias("v")), F.struct(_k().alias("v"))),
            ).alias("iaqi"),
        ).alias("data"),
    )
    return e.select(F.from_json(F.to_json(feed), schemas.SENSOR_FEED).alias("f")).select("f.*")


def _pollutant():
    return F.when(F.col("event_type") == "click", "pm25").otherwise(F.col("event_type"))


def _k():
    return F.from_json("props", "map<string,double>")["k"]


@query(
    "props_map_pivot",
    """SELECT user_id AS sensor_id, ts, CAST(floor(value) AS INTEGER) AS aqi, event_type AS dominentpol,
       CASE WHEN event_type = 'click' THEN value END AS iaqi_pm25, CASE WHEN event_type = 'view' THEN value END AS iaqi_view,
       CAST(props ->> '$.k' AS DOUBLE) AS iaqi_k, NULL::DOUBLE AS iaqi_o3
    FROM events WHERE event_id % 11 <> 0""",
)
def props_map_pivot(spark, sf_dir):
    out = landing.feed_pollutants(sensor_feeds(spark, sf_dir), ("pm25", "view", "k", "o3"))
    return out.withColumn("ts", local_clock(F.col("ts"), "UTC"))


@query(
    "props_map_entries",
    """SELECT user_id AS sensor_id, ts, CASE WHEN event_type = 'click' THEN 'pm25' ELSE event_type END AS pollutant, value
       FROM events WHERE event_id % 11 <> 0
    UNION ALL SELECT user_id, ts, 'k', CAST(props ->> '$.k' AS DOUBLE) FROM events WHERE event_id % 11 <> 0""",
)
def props_map_entries(spark, sf_dir):
    out = landing.feed_pollutants_long(sensor_feeds(spark, sf_dir))
    return out.withColumn("ts", local_clock(F.col("ts"), "UTC"))


@query(
    "sensor_feed_pm25",
    """SELECT DATE '2024-02-01' AS date, round(CASE WHEN event_type = 'click' THEN CAST(value AS REAL) END::DOUBLE, 3) AS pm25,
       'Singapore' AS city, user_id AS sensor_id FROM events WHERE event_id % 11 <> 0""",
)
def sensor_feed_pm25(spark, sf_dir):
    out = landing.feed_pm25(sensor_feeds(spark, sf_dir), "Singapore", F.lit("2024-02-01").cast("date"))
    return out.withColumn("pm25", F.round(F.col("pm25").cast("double"), 3))
