"""Missing values, expectations and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import clean, quality
from aerolith.registry import query
from aerolith.registry import adapters as a

_GAPPY = f"""{a.READINGS}, gappy AS (
  SELECT event_type, user_id AS sensor_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE value END AS pm25,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE wind_speed END AS wind_speed FROM readings)"""


def gappy(spark, sf_dir):
    return a.readings(spark, sf_dir).select(
        "event_type", F.col("user_id").alias("sensor_id"),
        F.when(F.col("event_id") % 50 != 0, F.col("value")).alias("pm25"),
        F.when(F.col("event_id") % 97 != 0, F.col("wind_speed")).alias("wind_speed"),
    )


@query(
    "null_report",
    f"""WITH {_GAPPY}, n AS (SELECT count(*) - count(event_type) AS e, count(*) - count(sensor_id) AS s,
      count(*) - count(pm25) AS p, count(*) - count(wind_speed) AS w FROM gappy)
    SELECT 'event_type' AS "column", e AS missing FROM n UNION ALL SELECT 'sensor_id', s FROM n
    UNION ALL SELECT 'pm25', p FROM n UNION ALL SELECT 'wind_speed', w FROM n
    UNION ALL SELECT '(total)', e + s + p + w FROM n""",
)
def null_report(spark, sf_dir):
    return quality.null_counts(gappy(spark, sf_dir))


@query(
    "expectation_report",
    f"""WITH {_GAPPY}, m AS (SELECT min(pm25) AS p, min(wind_speed - 1) AS w FROM gappy)
    SELECT 'pm25' AS "column", p AS observed, -0.1e0 AS low, 500e0 AS high, p > -0.1 AND p <= 500 AS passed FROM m
    UNION ALL SELECT 'below_zero', w, -0.1e0, 1000e0, w > -0.1 AND w <= 1000 FROM m""",
)
def expectation_report(spark, sf_dir):
    g = gappy(spark, sf_dir).withColumn("below_zero", F.col("wind_speed") - 1)
    return quality.check_minima(g, [("pm25", -0.1, 500.0), ("below_zero", -0.1, 1000.0)])


@query(
    "null_gate",
    f"""WITH {_GAPPY}, n AS (SELECT sensor_id, count(*) - count(pm25) AS missing FROM gappy GROUP BY 1)
    SELECT min(missing) AS least, max(missing) AS most, min(missing) = max(missing) AS equal,
           max(missing) < 20 AS below_limit FROM n""",
)
def null_gate(spark, sf_dir):
    return quality.null_gate(gappy(spark, sf_dir), "sensor_id", "pm25")


@query(
    "column_profile",
    f"""WITH {_GAPPY} SELECT 'event_type' AS "column", 'string' AS type, count(event_type) AS present, count(*) - count(event_type) AS missing FROM gappy
    UNION ALL SELECT 'sensor_id', 'bigint', count(sensor_id), count(*) - count(sensor_id) FROM gappy
    UNION ALL SELECT 'pm25', 'double', count(pm25), count(*) - count(pm25) FROM gappy
    UNION ALL SELECT 'wind_speed', 'double', count(wind_speed), count(*) - count(wind_speed) FROM gappy""",
)
def column_profile(spark, sf_dir):
    return clean.column_profile(gappy(spark, sf_dir))
