"""Unions and de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.functions.times import hour_start
from aerolith.operators import merge
from aerolith.operators.clean import keep_existing, rename
from aerolith.registry import query
from aerolith.registry import adapters as a

# Yearly tables with overlap: events by id, so that station hours recur in several years.
_YEARLY = f"""{a.READINGS}, yearly AS (
  SELECT CAST(2023 + event_id % 3 AS INTEGER) AS year, station_id AS station_name, date_trunc('hour', "timestamp") AS "timestamp",
         avg(wind_speed) AS wind_speed_avg, count(*) AS reading_count, arg_min(latitude, "timestamp") AS latitude,
         arg_min(longitude, "timestamp") AS longitude
  FROM readings GROUP BY 1, 2, 3)"""
_MEASURES = ", ".join(a.sql_round(c, c) for c in ("wind_speed_avg", "latitude", "longitude"))


def yearly(spark, sf_dir):
    r = a.readings(spark, sf_dir)
    return r.groupBy(
        (2023 + F.col("event_id") % 3).cast("int").alias("year"), F.col("station_id").alias("station_name"),
        hour_start(F.col("timestamp")).alias("_hour"),
    ).agg(
        F.avg("wind_speed").alias("wind_speed_avg"), F.count(F.lit(1)).alias("reading_count"),
        F.min_by("latitude", "timestamp").alias("latitude"), F.min_by("longitude", "timestamp").alias("longitude"),
    ).withColumnRenamed("_hour", "timestamp")


@query(
    "yearly_merge_keep_first",
    f"""WITH {_YEARLY}, k AS (
      SELECT *, row_number() OVER (PARTITION BY station_name, "timestamp" ORDER BY year) AS n FROM yearly)
    SELECT "timestamp", station_name, {_MEASURES}, reading_count FROM k WHERE n = 1""",
)
def yearly_merge_keep_first(spark, sf_dir):
    # The dump also carries an id and a year; the merged table keeps the wanted columns only.
    return a.rounded(merge.merge_yearly(yearly(spark, sf_dir).withColumn("station_id", F.lit("x"))))


_SPLIT = f"""{_YEARLY},
  fresh AS (SELECT station_name AS region, "timestamp", wind_speed_avg FROM yearly WHERE year >= 2024),
  history AS (SELECT station_name AS region, "timestamp", wind_speed_avg FROM yearly WHERE year <= 2024)"""


def _split(spark, sf_dir):
    y = rename(yearly(spark, sf_dir), {"station_name": "region"})
    columns = ["region", "timestamp", "wind_speed_avg"]
    # One row per key on the fresh side: the latest year.
    fresh = merge.keep_first(y.filter(F.col("year") >= 2024), ["region", "timestamp"], [F.col("year").desc()])
    return fresh.select(*columns), y.filter(F.col("year") <= 2024).select(*columns)


@query(
    "history_union_dedupe_row",
    f"""WITH {_YEARLY}, x AS (
      SELECT station_name AS region, "timestamp", year, {a.sql_round('wind_speed_avg', 'wind_speed_avg')} FROM yearly),
    fresh AS (SELECT region, "timestamp", wind_speed_avg FROM x WHERE year >= 2024
              QUALIFY row_number() OVER (PARTITION BY region, "timestamp" ORDER BY year DESC) = 1)
    SELECT * FROM fresh UNION SELECT region, "timestamp", wind_speed_avg FROM x WHERE year <= 2024""",
)
def history_union_dedupe_row(spark, sf_dir):
    fresh, history = _split(spark, sf_dir)
    return merge.union_history(a.rounded(fresh), a.rounded(history), mode="row")


@query(
    "history_union_dedupe_key",
    f"""WITH {_YEARLY}, x AS (SELECT station_name AS region, "timestamp", year, wind_speed_avg FROM yearly),
    fresh AS (SELECT region, "timestamp", wind_speed_avg FROM x WHERE year >= 2024
              QUALIFY row_number() OVER (PARTITION BY region, "timestamp" ORDER BY year DESC) = 1),
    history AS (SELECT region, "timestamp", wind_speed_avg FROM x WHERE year < 2024),
    u AS (SELECT * FROM fresh UNION ALL
          SELECT h.* FROM history h WHERE NOT EXISTS (
            SELECT 1 FROM fresh f WHERE f.region = h.region AND f."timestamp" = h."timestamp"))
    SELECT region, "timestamp", {a.sql_round('wind_speed_avg', 'wind_speed_avg')} FROM u""",
)
def history_union_dedupe_key(spark, sf_dir):
    fresh, history = _split(spark, sf_dir)
    history = history.join(fresh, ["region", "timestamp"], "left_anti").unionByName(fresh)
    return a.rounded(merge.union_history(fresh, history))


@query(
    "union_all_by_name",
    f"""WITH {a.READINGS}
    SELECT event_id, station_id, {a.sql_round('wind_speed', 'wind_speed')}, NULL::DOUBLE AS wind_direction
    FROM readings WHERE event_type = 'click'
    UNION ALL SELECT event_id, station_id, NULL, {a.sql_round('wind_direction', 'wind_direction')}
    FROM readings WHERE event_type <> 'click'""",
)
def union_all_by_name(spark, sf_dir):
    r = a.readings(spark, sf_dir)
    speeds = r.filter(F.col("event_type") == "click").select("event_id", "station_id", "wind_speed")
    directions = r.filter(F.col("event_type") != "click").select("wind_direction", "station_id", "event_id")
    return a.rounded(merge.union_all(speeds, directions))


@query(
    "station_metadata_merge",
    """SELECT 'S' || user_id AS id, event_type AS name, props AS device_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) = 1""",
)
def station_metadata_merge(spark, sf_dir):
    mentions = a.table(spark, sf_dir, "events").select(
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("id"), F.col("event_type").alias("name"),
        F.col("props").alias("device_id"), F.to_date("ts").alias("day"), F.col("event_id").alias("page"),
    )
    return merge.merge_station_metadata(mentions, fields=("name", "device_id"))


@query(
    "reorder_existing_columns",
    """SELECT s_name AS station_name, s_acctbal AS reading, s_suppkey AS station FROM supplier""",
)
def reorder_existing_columns(spark, sf_dir):
    s = rename(a.table(spark, sf_dir, "supplier"), {"s_name": "station_name", "s_acctbal": "reading", "s_suppkey": "station"})
    return keep_existing(s, ["station_name", "missing_column", "reading", "station"])
