"""The test tables in the role of sensor data, in Spark and in SQL.

    events   -> readings of stations (user_id), or hourly series of regions (event_type)
    orders   -> daily PM2.5 series of regions;  lineitem -> daily weather of regions
    supplier -> station dimension (only some stations are in it)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import angles
from aerolith.functions.geo import nearest_region
from aerolith.functions.times import hour_start
from aerolith.operators.clean import valid_directions
from aerolith.session import materialize

DIGITS = 6
# Values with two decimals, divided by this, do not average to the middle between two
# six-digit numbers, where engines would round to different sides.
SCALE = 9.973


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to fixed digits (engines sum in different orders), and -0.0 to 0.0."""
    return df.select(
        *[
            (F.round(F.col(f.name).cast("double"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def wrap_angle(df: DataFrame, *columns: str) -> DataFrame:
    """Rounded angles to [0, 360): a tiny negative mean plus 360 is the same as 0."""
    return df.withColumns({c: F.pmod(F.col(c), F.lit(360.0)) + F.lit(0.0) for c in columns})


# --- SQL building blocks ----------------------------------------------------------------


def sql_round(expression: str, name: str) -> str:
    return f'round({expression}, {DIGITS}) + 0.0 AS "{name}"'


def sql_wrapped(expression: str, name: str) -> str:
    return f'CASE WHEN round({expression}, {DIGITS}) >= 360 THEN 0.0 ELSE round({expression}, {DIGITS}) + 0.0 END AS "{name}"'


def sql_circular_mean(x: str) -> str:
    d = f"degrees(atan2(avg(sin(radians({x}))), avg(cos(radians({x})))))"
    return f"(CASE WHEN {d} < 0 THEN {d} + 360 ELSE {d} END)"


def sql_circular_std(x: str) -> str:
    r = f"least(1e0, sqrt(avg(cos(radians({x})))**2 + avg(sin(radians({x})))**2))"
    return f"(CASE WHEN {r} = 0 THEN 'inf'::DOUBLE ELSE abs(sqrt(-2 * ln(nullif({r}, 0)))) END)"


def _distance(lat: float, lon: float) -> str:
    return f"((latitude-{lat!r}e0)*(latitude-{lat!r}e0)+(longitude-{lon!r}e0)*(longitude-{lon!r}e0))"


# The SQL's own numbers.
_SQL_CENTROIDS = (
    ("central", 1.3521, 103.8198), ("north", 1.4180, 103.8270), ("south", 1.2800, 103.8500), ("east", 1.3500, 103.9400),
    ("west", 1.3400, 103.7000),
)


def sql_region(otherwise: str = "NULL") -> str:
    distances = [_distance(lat, lon) for _, lat, lon in _SQL_CENTROIDS]
    least = f"least({', '.join(distances)})"
    whens = " ".join(f"WHEN {d} = {least} THEN '{name}'" for d, (name, _, _) in zip(distances, _SQL_CENTROIDS))
    return f"CASE {whens} ELSE {otherwise} END"


READINGS = f"""
readings AS (
  SELECT event_id, ts AS "timestamp", user_id, 'S' || user_id AS station_id, event_type, value, props,
         CAST((event_id * 37) % 400 - 20 AS DOUBLE) + (value - floor(value)) AS wind_direction,
         value / 9.973e0 AS wind_speed,
         CASE WHEN event_id % 97 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text,
         1.20e0 + CAST(user_id % 50 AS DOUBLE) * 0.005e0 AS latitude,
         103.60e0 + CAST((user_id * 7) % 150 AS DOUBLE) * 0.003e0 AS longitude
  FROM events
),
located AS (SELECT *, {sql_region()} AS region FROM readings),
valid AS (SELECT * FROM located WHERE wind_direction BETWEEN 0 AND 360)
"""

HOURLY = f"""
{READINGS},
hourly AS (
  SELECT event_type AS region, date_trunc('hour', "timestamp") AS "timestamp",
         avg(wind_speed) * 10 AS pm25, avg(wind_speed) AS wind_speed_avg, avg(20 + wind_speed / 10) AS air_temperature_avg
  FROM readings GROUP BY 1, 2
),
hourly_direction AS (
  SELECT event_type AS region, date_trunc('hour', "timestamp") AS "timestamp",
         {sql_circular_mean('wind_direction')} AS wind_direction_avg,
         {sql_circular_std('wind_direction')} AS wind_direction_std
  FROM valid GROUP BY 1, 2
)
"""

DAILY = """
placed AS (
  SELECT o.o_orderkey, o.o_orderdate AS "timestamp", o.o_totalprice, r.r_name AS region
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
),
daily AS (SELECT region, "timestamp", avg(o_totalprice) / 9973e0 AS pm25 FROM placed GROUP BY 1, 2),
weather AS (
  SELECT region, "timestamp", avg(l_quantity) * 7.2e0 AS wind_direction_avg_mean, avg(l_tax) * 10 AS wind_direction_avg_std,
         avg(l_discount) * 100 AS wind_speed_avg_mean, 25 + avg(l_tax) * 50 AS air_temperature_avg_mean,
         sum(l_quantity) AS precipitation_sum
  FROM placed JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2
)
"""


# --- the same in Spark ------------------------------------------------------------------


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    user = F.col("user_id")
    return e.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "user_id",
        F.concat(F.lit("S"), user.cast("string")).alias("station_id"),
        "event_type",
        "value",
        "props",
        (((F.col("event_id") * 37) % 400 - 20).cast("double") + (F.col("value") - F.floor("value"))).alias("wind_direction"),
        (F.col("value") / SCALE).alias("wind_speed"),
        F.when(F.col("event_id") % 97 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value_text"),
        (F.lit(1.20) + (user % 50).cast("double") * 0.005).alias("latitude"),
        (F.lit(103.60) + ((user * 7) % 150).cast("double") * 0.003).alias("longitude"),
    )


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).withColumn("region", nearest_region(F.col("latitude"), F.col("longitude")))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = readings(spark, sf_dir)
    return r.groupBy(F.col("event_type").alias("region"), hour_start(F.col("timestamp")).alias("timestamp")).agg(
        (F.avg("wind_speed") * 10).alias("pm25"),
        F.avg("wind_speed").alias("wind_speed_avg"),
        F.avg(20 + F.col("wind_speed") / 10).alias("air_temperature_avg"),
    )


def hourly_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = valid_directions(readings(spark, sf_dir), "wind_direction")
    return r.groupBy(F.col("event_type").alias("region"), hour_start(F.col("timestamp")).alias("timestamp")).agg(
        angles.circular_mean(F.col("wind_direction")).alias("wind_direction_avg"),
        angles.circular_std(F.col("wind_direction")).alias("wind_direction_std"),
    )


def placed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    places = (
        table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region"))
    )
    return orders.join(places, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", F.col("o_orderdate").alias("timestamp"), "o_totalprice", "region"
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        placed_orders(spark, sf_dir).groupBy("region", "timestamp")
        .agg((F.avg("o_totalprice") / 9973.0).alias("pm25"))
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("l_quantity").alias("n"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_discount").alias("discount"), F.sum("l_tax").alias("tax"),
    )


def _weather_columns() -> list[Column]:
    n = F.sum("n")
    return [
        (F.sum("quantity") / n * 7.2).alias("wind_direction_avg_mean"),
        (F.sum("tax") / n * 10).alias("wind_direction_avg_std"),
        (F.sum("discount") / n * 100).alias("wind_speed_avg_mean"),
        (25 + F.sum("tax") / n * 50).alias("air_temperature_avg_mean"),
        F.sum("quantity").alias("precipitation_sum"),
    ]


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items fold per order first: the exchange the join needs also aggregates, and the
    join meets one row per order instead of one per line."""
    joined = placed_orders(spark, sf_dir).drop("o_totalprice").join(
        _order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey")
    )
    return joined.groupBy("region", "timestamp").agg(*_weather_columns())


def daily_and_weather(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``daily`` and ``weather`` of one pass over the orders, computed once.

    An order's lines are one row, so the outer join keeps each order as often as it is there;
    days on which no order has lines are days without weather.
    """
    joined = placed_orders(spark, sf_dir).join(
        _order_lines(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    both = materialize(
        joined.groupBy("region", "timestamp").agg(
            (F.avg("o_totalprice") / 9973.0).alias("pm25"), *_weather_columns(), F.count("l_orderkey").alias("_with_lines")
        )
    )
    days = both.select("region", "timestamp", "pm25")
    return days, both.filter(F.col("_with_lines") > 0).drop("pm25", "_with_lines")


def daily_tables(spark: SparkSession, sf_dir: str, stored: bool = True) -> dict[str, DataFrame]:
    """The four daily base tables.

    ``stored``: both rollups are computed once, in one pass, for their four users.  Without it filters
    reach the rollups and their scans, which is better for a user of few days.
    """
    days, w = daily_and_weather(spark, sf_dir) if stored else (daily(spark, sf_dir), weather(spark, sf_dir))
    return {
        "pm25": days,
        "direction": w.select("region", "timestamp", "wind_direction_avg_mean", "wind_direction_avg_std"),
        "speed": w.select("region", "timestamp", "wind_speed_avg_mean"),
        "temperature": w.select("region", "timestamp", "air_temperature_avg_mean"),
    }
