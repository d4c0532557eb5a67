"""As-of and interval joins (J8, J10) and the nearest of many centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import places
from aerolith.operators.time_joins import asof_join, interval_join, overlap_join
from aerolith.registry import query
from aerolith.registry import adapters as a


def _typed(spark, sf_dir, condition: str, prefix: str):
    rows = a.readings(spark, sf_dir).filter(condition)
    return rows.select(
        F.col("user_id").alias("station"), F.col("event_id").alias(f"{prefix}_id"), F.col("timestamp").alias(f"{prefix}_time"),
        F.col("wind_speed").alias(f"{prefix}_value"),
    )


_ASOF = f"""WITH {a.READINGS},
  asked AS (SELECT user_id AS station, event_id, "timestamp" AS t FROM readings WHERE event_id % 3 <> 0),
  known AS (SELECT user_id AS station, event_id, "timestamp" AS t, wind_speed FROM readings WHERE event_id % 3 = 0),
  best AS (
    SELECT s.event_id, k.event_id AS known_id, k.t, k.wind_speed,
           row_number() OVER (PARTITION BY s.event_id ORDER BY k.t DESC, k.event_id DESC) AS n
    FROM asked s JOIN known k ON k.station = s.station AND k.t <= s.t AND k.t >= s.t - INTERVAL 12 HOURS)
  SELECT s.station, s.event_id, b.known_id, b.t AS known_time, {a.sql_round('b.wind_speed', 'known_value')}
  FROM asked s LEFT JOIN best b ON b.event_id = s.event_id AND b.n = 1"""


@query("asof_join", _ASOF)
def asof(spark, sf_dir):
    """Each reading with the station's latest calibrating one (every third) of the twelve hours before."""
    asked = _typed(spark, sf_dir, "event_id % 3 <> 0", "event").drop("event_value")
    known = _typed(spark, sf_dir, "event_id % 3 = 0", "known")
    out = asof_join(
        asked, known, ["station"], "event_time", ["known_id", "known_value"], right_on="known_time", tolerance="12 HOURS",
        tie=["known_id"], matched="known_time",
    )
    return a.rounded(out.select("station", "event_id", "known_id", "known_time", "known_value"))


@query(
    "asof_join_hot_key",
    f"""WITH {a.READINGS},
    keyed AS (SELECT CASE WHEN event_id % 3 < 2 THEN 'hot' ELSE event_type END AS key, event_id, "timestamp" AS t FROM readings),
    series AS (
      SELECT *, max(CASE WHEN event_id % 50 = 0 THEN epoch_us(t) END) OVER (PARTITION BY key ORDER BY t) AS last_mark FROM keyed)
    SELECT key, event_id, last_mark FROM series""",
)
def asof_hot(spark, sf_dir):
    """The time of the last marked reading, with two thirds of all readings under one key."""
    hot = F.when(F.col("event_id") % 3 < 2, "hot").otherwise(F.col("event_type"))
    rows = a.readings(spark, sf_dir).select(hot.alias("key"), "event_id", F.col("timestamp").alias("t"))
    marks = rows.filter("event_id % 50 = 0").select("key", "t", F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', t)").alias("last_mark"))
    return asof_join(rows, marks, ["key"], "t", ["last_mark"]).select("key", "event_id", "last_mark")


def _spans(spark, sf_dir):
    """Alerts of stations: from a reading on, for minutes to days."""
    hours = F.make_dt_interval(hours=(F.col("event_id") % 60 + 1).cast("int"), mins=(F.col("event_id") % 7).cast("int"))
    rows = a.readings(spark, sf_dir).filter("event_id % 40 = 0")
    return rows.select("user_id", F.col("event_id").alias("alert_id"), F.col("timestamp").alias("start"), (F.col("timestamp") + hours).alias("stop"))


_SQL_SPANS = """spans AS (
    SELECT user_id, event_id AS alert_id, "timestamp" AS start,
           "timestamp" + to_hours(CAST(event_id % 60 + 1 AS INTEGER)) + to_minutes(CAST(event_id % 7 AS INTEGER)) AS stop
    FROM readings WHERE event_id % 40 = 0)"""


@query(
    "interval_join",
    f"""WITH {a.READINGS}, {_SQL_SPANS}
    SELECT r.event_id, s.alert_id, s.start, s.stop FROM readings r LEFT JOIN spans s
    ON r.user_id = s.user_id AND r."timestamp" >= s.start AND r."timestamp" < s.stop""",
)
def intervals(spark, sf_dir):
    """Every reading with the alerts of its station that were on, if any."""
    rows = a.readings(spark, sf_dir).select("user_id", "event_id", "timestamp")
    out = interval_join(rows, _spans(spark, sf_dir), ["user_id"], "timestamp", "start", "stop", how="left")
    return out.select("event_id", "alert_id", "start", "stop")


@query(
    "overlap_join",
    f"""WITH {a.READINGS}, {_SQL_SPANS}
    SELECT x.alert_id, y.alert_id AS other_id FROM spans x JOIN spans y ON x.user_id = y.user_id
    AND x.alert_id < y.alert_id AND x.start < y.stop AND y.start < x.stop""",
)
def overlaps(spark, sf_dir):
    """Pairs of alerts of a station that were on at the same time."""
    spans = _spans(spark, sf_dir)
    other = spans.withColumnsRenamed({"alert_id": "other_id", "start": "other_start", "stop": "other_stop"})
    out = overlap_join(spans, other, ["user_id"], ("start", "stop"), ("other_start", "other_stop"))
    return out.filter("alert_id < other_id").select("alert_id", "other_id")


@query(
    "nearest_of_many",
    """WITH fixed AS (
      SELECT c_custkey AS place, c_name AS name, 1.2e0 + CAST((c_custkey * 7919) % 1009 AS DOUBLE) * 0.00025e0 AS lat,
             103.6e0 + CAST((c_custkey * 104729) % 2003 AS DOUBLE) * 0.00021e0 AS lon FROM customer),
    points AS (
      SELECT o_orderkey, 1.15e0 + CAST((o_orderkey * 31) % 3001 AS DOUBLE) * 0.00011e0 AS lat,
             103.55e0 + CAST((o_orderkey * 17) % 4001 AS DOUBLE) * 0.00013e0 AS lon FROM orders),
    far AS (
      SELECT p.o_orderkey, f.place, f.name, (p.lat - f.lat) * (p.lat - f.lat) + (p.lon - f.lon) * (p.lon - f.lon) AS d
      FROM points p CROSS JOIN fixed f)
    SELECT o_orderkey, arg_min(name, {'d': d, 'place': place}) AS region FROM far GROUP BY 1""",
)
def nearest_many(spark, sf_dir):
    """Thousands of centroids (customers) and points (orders) beside and beyond them."""
    number = lambda column, by, top: ((F.col(column) * by) % top).cast("double")
    fixed = a.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("place"), F.col("c_name").alias("name"),
        (F.lit(1.2) + number("c_custkey", 7919, 1009) * 0.00025).alias("lat"),
        (F.lit(103.6) + number("c_custkey", 104729, 2003) * 0.00021).alias("lon"),
    )
    points = a.table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.lit(1.15) + number("o_orderkey", 31, 3001) * 0.00011).alias("latitude"),
        (F.lit(103.55) + number("o_orderkey", 17, 4001) * 0.00013).alias("longitude"),
    )
    return places.nearest_of_many(points, fixed).select("o_orderkey", "region")
