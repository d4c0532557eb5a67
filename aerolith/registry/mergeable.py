"""Mergeable sketches (A17), grouping sets (A23), tables stored for their join."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolith.operators import sketches
from aerolith.registry import query
from aerolith.registry import adapters as a
from aerolith.registry.joins import _MEASURES, _VIEW, _rounded_columns
from aerolith.session import materialize
from aerolith.sinks.buckets import join_bucketed, store_bucketed


@query(
    "sketches_to_months",
    f"""WITH {a.READINGS}
    SELECT event_type, date_trunc('month', "timestamp") AS period, count(wind_speed) AS n, count(DISTINCT user_id) AS stations,
           TRUE AS stations_within_error, TRUE AS median_within_error
    FROM readings GROUP BY 1, 2""",
)
def sketches_to_months(spark, sf_dir):
    """Hours' sketches merged to days and these to months; beside the exact count, whether the estimates keep their error:
    the distinct count within four standard errors, the median's rank within the sketch's bound."""
    r = a.readings(spark, sf_dir).select("event_type", "timestamp", "user_id", "wind_speed")
    names = ("user_id", "wind_speed")
    states = materialize(sketches.hour_sketches(r, *names, keys=["event_type"]))
    days = sketches.merged(states, *names, "day", ["event_type"])
    months = sketches.merged(days, *names, "month", ["event_type"], at="period")
    found = materialize(sketches.estimates(months, *names))
    exact = r.withColumn("period", F.date_trunc("month", "timestamp")).join(
        found.select("event_type", "period", "wind_speed_q50", "n"), ["event_type", "period"]
    )
    # The estimate's true rank: the share of values below it, and of those not above it.
    ranks = exact.groupBy("event_type", "period").agg(
        F.count_distinct("user_id").alias("stations"),
        F.avg((F.col("wind_speed") < F.col("wind_speed_q50")).cast("double")).alias("_below"),
        F.avg((F.col("wind_speed") <= F.col("wind_speed_q50")).cast("double")).alias("_upto"),
    )
    out = found.join(ranks, ["event_type", "period"])
    off = F.abs(F.col("distinct_user_id") - F.col("stations")) / F.col("stations")
    inside = (F.col("_below") <= 0.5 + sketches.RANK_ERROR) & (F.col("_upto") >= 0.5 - sketches.RANK_ERROR)
    return out.select(
        "event_type", F.col("period").cast("timestamp_ntz").alias("period"), "n", "stations",
        (off <= 4 * sketches.DISTINCT_ERROR).alias("stations_within_error"), inside.alias("median_within_error"),
    )


@query(
    "totals_by_region_and_day",
    f"""WITH {a.READINGS}, d AS (SELECT region, CAST("timestamp" AS DATE) AS day, event_type, wind_speed FROM located)
    SELECT region, day, event_type, CAST(GROUPING(region, day, event_type) AS INTEGER) AS level, count(wind_speed) AS n,
           {a.sql_round('avg(wind_speed)', 'wind_speed_mean')}, {a.sql_round('min(wind_speed)', 'wind_speed_min')},
           {a.sql_round('max(wind_speed)', 'wind_speed_max')}
    FROM d GROUP BY CUBE (region, day, event_type)""",
)
def totals_by_region_and_day(spark, sf_dir):
    """All totals over region, day and type, from those of single cells to the grand total, in one scan."""
    r = a.located(spark, sf_dir).select("region", F.to_date("timestamp").alias("day"), "event_type", "wind_speed")
    return a.rounded(sketches.totals(r, ["region", "day", "event_type"], "wind_speed"))


@query(
    "feature_view_join_bucketed",
    f'WITH {a.DAILY}, {_VIEW} SELECT region, "timestamp", {_rounded_columns(_MEASURES)} FROM view',
)
def feature_view_join_bucketed(spark, sf_dir):
    """The four daily tables stored by key, joined without an exchange."""
    t = a.daily_tables(spark, sf_dir)
    stored = [store_bucketed(t[k], ["region", "timestamp"], 4, k) for k in ("pm25", "direction", "speed", "temperature")]
    return a.rounded(join_bucketed(*stored, on=["region", "timestamp"]))
