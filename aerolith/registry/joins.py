"""Joins (J1-J9), top-k (O2, O3), splits (M1) and hindcasts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from aerolith.functions.text import station_name_or_default
from aerolith.operators import joins
from aerolith.operators.features import add_calendar, table_features
from aerolith.operators.forecast import linear_scorer
from aerolith.operators.metrics import regression_metrics
from aerolith.operators.model import split_by_time
from aerolith.plans.predict import hindcast_metrics, monitoring_backfill
from aerolith.registry import query
from aerolith.registry import adapters as a

AS_OF = "2001-01-01"


@query(
    "station_lookup_default",
    f"""WITH {a.READINGS}
    SELECT event_id, station_id, coalesce(s_name, 'Unknown') AS station_name, {a.sql_round('s_acctbal', 'latitude')}
    FROM readings LEFT JOIN supplier ON 'S' || s_suppkey = station_id""",
)
def station_lookup_default(spark, sf_dir):
    # The supplier table as station dimension, its balance in the place of a coordinate.
    stations = a.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("latitude"), F.col("s_acctbal").alias("longitude"),
    )
    readings = a.readings(spark, sf_dir).select("event_id", "station_id")
    return a.rounded(joins.station_lookup(readings, stations).drop("longitude"))


_VIEW = """view AS (
  SELECT d.region, d."timestamp", d.pm25, w.wind_direction_avg_mean, w.wind_direction_avg_std, w.wind_speed_avg_mean,
         w.air_temperature_avg_mean
  FROM daily d JOIN weather w ON d.region = w.region AND d."timestamp" = w."timestamp")"""
_MEASURES = ("pm25", "wind_direction_avg_mean", "wind_direction_avg_std", "wind_speed_avg_mean", "air_temperature_avg_mean")
_WEATHER_MEASURES = _MEASURES[1:]


def _rounded_columns(names, prefix: str = "") -> str:
    return ", ".join(a.sql_round(f"{prefix}{n}", n) for n in names)


def view(spark, sf_dir):
    t = a.daily_tables(spark, sf_dir)
    return joins.feature_view(t["pm25"], t["direction"], t["speed"], t["temperature"])


@query(
    "feature_view_join",
    f'WITH {a.DAILY}, {_VIEW} SELECT region, "timestamp", {_rounded_columns(_MEASURES)} FROM view',
)
def feature_view_join(spark, sf_dir):
    return a.rounded(view(spark, sf_dir))


@query(
    "future_weather_top7",
    f"""WITH {a.DAILY}, f AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY region ORDER BY "timestamp") AS INTEGER) AS days_before_forecast_day
      FROM weather WHERE "timestamp" >= TIMESTAMP '{AS_OF}')
    SELECT region, "timestamp", days_before_forecast_day, {_rounded_columns(_WEATHER_MEASURES)}
    FROM f WHERE days_before_forecast_day <= 7""",
)
def future_weather_top7(spark, sf_dir):
    t = a.daily_tables(spark, sf_dir, stored=False)
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return a.rounded(joins.future_weather(t["direction"], t["speed"], t["temperature"], as_of))


@query(
    "last_10",
    f"""WITH {a.DAILY}, f AS (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS n FROM daily)
    SELECT region, "timestamp", {a.sql_round('pm25', 'pm25')} FROM f WHERE n <= 10""",
)
def last_10(spark, sf_dir):
    return a.rounded(joins.last_rows(a.daily(spark, sf_dir), 10))


@query(
    "train_test_split_counts",
    f"""WITH {a.DAILY}, l AS (
      SELECT *, lag(pm25, 7) OVER (PARTITION BY region ORDER BY "timestamp") AS pm25_lag_7d FROM daily)
    SELECT 'train' AS part, region, count(*) AS "rows" FROM l
    WHERE "timestamp" < TIMESTAMP '{AS_OF}' AND pm25_lag_7d IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'test', region, count(*) FROM l WHERE "timestamp" >= TIMESTAMP '{AS_OF}' GROUP BY ALL""",
)
def train_test_split_counts(spark, sf_dir):
    by_region = Window.partitionBy("region").orderBy("timestamp")  # one row per region and day
    lagged = a.daily(spark, sf_dir).withColumn("pm25_lag_7d", F.lag("pm25", 7).over(by_region))
    train, test = split_by_time(lagged, AS_OF)
    counts = [
        part.groupBy("region").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("part"), "region", "rows")
        for name, part in (("train", train), ("test", test))
    ]
    return counts[0].unionByName(counts[1])


_PREDICTIONS = " UNION ALL ".join(
    f"""SELECT region, "timestamp", {k} AS days_before_forecast_day,
        lag(pm25, {k}) OVER (PARTITION BY region ORDER BY "timestamp") AS predicted_pm25 FROM daily"""
    for k in (1, 2, 3)
)


def predictions(daily):
    """Persistence forecasts: the value k rows earlier as the prediction of horizon k."""
    by_region = Window.partitionBy("region").orderBy("timestamp")  # one row per region and day
    lagged = daily.select("region", "timestamp", *[F.lag("pm25", k).over(by_region).alias(str(k)) for k in (1, 2, 3)])
    long = lagged.unpivot(["region", "timestamp"], ["1", "2", "3"], "days_before_forecast_day", "predicted_pm25")
    return long.withColumn("days_before_forecast_day", F.col("days_before_forecast_day").cast("int")).filter(
        F.col("predicted_pm25").isNotNull()
    )


@query(
    "hindcast",
    f"""WITH {a.DAILY}, predictions AS ({_PREDICTIONS})
    SELECT p.region, p."timestamp", p.days_before_forecast_day, {a.sql_round('p.predicted_pm25', 'predicted_pm25')},
           {a.sql_round('d.pm25', 'pm25')}
    FROM predictions p JOIN daily d ON p.region = d.region AND p."timestamp" = d."timestamp"
    WHERE p.predicted_pm25 IS NOT NULL""",
)
def hindcast(spark, sf_dir):
    daily = a.materialize(a.daily(spark, sf_dir))
    return a.rounded(joins.hindcast(predictions(daily), daily))


_METRICS = f"""count(*) AS n, {a.sql_round('avg((pm25 - predicted_pm25)**2)', 'mse')},
  {a.sql_round('1 - sum((pm25 - predicted_pm25)**2) / (var_pop(pm25) * count(*))', 'r2')}"""


@query(
    "hindcast_metrics",
    f"""WITH {a.DAILY}, predictions AS ({_PREDICTIONS}), j AS (
      SELECT p.region, p.days_before_forecast_day, p.predicted_pm25, d.pm25
      FROM predictions p JOIN daily d ON p.region = d.region AND p."timestamp" = d."timestamp"
      WHERE p.predicted_pm25 IS NOT NULL)
    SELECT region, days_before_forecast_day, {_METRICS} FROM j GROUP BY 1, 2""",
)
def hindcast_by_horizon(spark, sf_dir):
    daily = a.materialize(a.daily(spark, sf_dir))
    return a.rounded(hindcast_metrics(joins.hindcast(predictions(daily), daily)))


@query(
    "regression_metrics",
    f"""WITH {a.DAILY}, j AS (
      SELECT p."timestamp", p.predicted_pm25, d.pm25 FROM ({_PREDICTIONS}) p
      JOIN daily d ON p.region = d.region AND p."timestamp" = d."timestamp" WHERE p.predicted_pm25 IS NOT NULL)
    SELECT {_METRICS} FROM j""",
)
def metrics_overall(spark, sf_dir):
    daily = a.materialize(a.daily(spark, sf_dir))
    return a.rounded(regression_metrics(joins.hindcast(predictions(daily), daily)))


_WEIGHTS = {"pm25_lag_1d": 0.6, "pm25_rolling_mean_7d": 0.3, "wind_speed_avg_mean": 0.2}


@query(
    "monitoring_backfill",
    f"""WITH {a.DAILY}, l AS (
      SELECT *, {', '.join(f'lag(pm25, {k}) OVER w AS l{k}' for k in (1, 28))},
             avg(pm25) OVER (PARTITION BY region ORDER BY "timestamp" ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m7
      FROM daily WINDOW w AS (PARTITION BY region ORDER BY "timestamp")),
    j AS (SELECT l.region, l."timestamp", l.pm25, 0.6e0 * l1 + 0.3e0 * m7 + 0.2e0 * wind_speed_avg_mean AS predicted_pm25
          FROM l JOIN weather w ON l.region = w.region AND l."timestamp" = w."timestamp" WHERE l28 IS NOT NULL),
    t AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS n FROM j)
    SELECT region, "timestamp", {_rounded_columns(("pm25", "predicted_pm25"))}, 1 AS days_before_forecast_day
    FROM t WHERE n <= 10""",
)
def monitoring(spark, sf_dir):
    t = a.daily_tables(spark, sf_dir)
    pm25 = table_features(add_calendar(t["pm25"], with_hour=False), "pm25_daily")
    out = monitoring_backfill(t["direction"], t["speed"], t["temperature"], pm25, linear_scorer(_WEIGHTS))
    return a.rounded(out.select("region", "timestamp", "pm25", "predicted_pm25", "days_before_forecast_day"))


@query(
    "semi_and_anti_joins",
    """SELECT s_suppkey, s_name, EXISTS (SELECT 1 FROM events WHERE user_id = s_suppkey) AS reporting FROM supplier""",
)
def semi_and_anti(spark, sf_dir):
    stations = a.table(spark, sf_dir, "supplier").select("s_suppkey", station_name_or_default(F.col("s_name")).alias("s_name"))
    seen = a.table(spark, sf_dir, "events").select(F.col("user_id").alias("s_suppkey"))
    with_data = stations.join(seen, "s_suppkey", "left_semi").withColumn("reporting", F.lit(True))
    without = stations.join(seen, "s_suppkey", "left_anti").withColumn("reporting", F.lit(False))
    return with_data.unionByName(without)
