"""Lookups and equi-joins.

No join is told to broadcast: Spark broadcasts a side on its own when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise falls back to a shuffle join
whose hot keys AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.functions.text import station_name_or_default

SERIES_KEY = ("region", "timestamp")


def station_lookup(readings: DataFrame, stations: DataFrame, key: str = "station_id") -> DataFrame:
    """Name and coordinates of each reading's station; unknown stations are kept."""
    known = stations.select(F.col("id").alias(key), F.col("name").alias("station_name"), "latitude", "longitude")
    joined = readings.join(known, key, "left")
    return joined.withColumn("station_name", station_name_or_default(F.col("station_name")))


def attach_coordinates(df: DataFrame, coordinates: DataFrame) -> DataFrame:
    return df.join(coordinates.select("region", "latitude", "longitude"), "region", "left")


def join_series(first: DataFrame, *others: DataFrame, on: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Inner join of keyed tables; a column that several have comes from the first.

    All sides hash on the same key, so each table is exchanged once, whatever their number.
    """
    out = first
    for other in others:
        repeated = [c for c in other.columns if c in out.columns and c not in on]
        out = out.join(other.drop(*repeated), list(on))
    return out


def join_series_with_suffixes(
    first: DataFrame, others: Sequence[tuple[str, DataFrame]], on: Sequence[str] = SERIES_KEY
) -> DataFrame:
    """Inner join that keeps clashing columns of later tables under a suffix."""
    out = first
    for suffix, other in others:
        clash = {c: f"{c}{suffix}" for c in other.columns if c in out.columns and c not in on}
        out = out.join(other.withColumnsRenamed(clash), list(on))
    return out


def feature_view(
    pm25: DataFrame, direction: DataFrame, speed: DataFrame, temperature: DataFrame, region: str | None = None
) -> DataFrame:
    """The training table: PM2.5 with the weather of the same region and day."""
    tables = [pm25, direction, speed, temperature]
    if region is not None:
        tables = [t.filter(F.col("region") == region) for t in tables]
    return join_series(*tables)


def future_weather(
    direction: DataFrame, speed: DataFrame, temperature: DataFrame, as_of, days: int = 7
) -> DataFrame:
    """The next days of weather per region, starting at ``as_of``, numbered 1, 2, ..."""
    tables = [t.filter(F.col("timestamp") >= F.lit(as_of)) for t in (direction, speed, temperature)]
    return first_rows(join_series(*tables), days, numbered_as="days_before_forecast_day")


def first_rows(
    df: DataFrame, n: int, keys: Sequence[str] = ("region",), order: Sequence[str | Column] = ("timestamp",),
    numbered_as: str | None = None,
) -> DataFrame:
    """First n rows per key.  Spark keeps at most n rows per key and task before the shuffle."""
    rank = numbered_as or "_rank"
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)
    return ranked if numbered_as else ranked.drop(rank)


def last_rows(
    df: DataFrame, n: int, keys: Sequence[str] = ("region",), order: str = "timestamp", tie: Sequence[str] = ()
) -> DataFrame:
    return first_rows(df, n, keys, [F.col(order).desc(), *[F.col(c).desc() for c in tie]])


def hindcast(predictions: DataFrame, outcomes: DataFrame, region: str | None = None) -> DataFrame:
    """Predictions next to what happened; every forecast horizon of a day is kept."""
    left = predictions.drop("pm25")
    right = outcomes.select("timestamp", "region", "pm25")
    if region is not None:
        left, right = (t.filter(F.col("region") == region) for t in (left, right))
    return left.join(right, ["timestamp", "region"])
