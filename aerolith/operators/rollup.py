"""Hourly, daily and per-station rollups.

Every aggregate here has a fixed-width buffer, so Spark plans hash aggregation with a
map-side partial step: a region holding a third of all readings costs one buffer per
(task, hour), and only buffers are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import angles
from aerolith.functions.airquality import concentration_to_index
from aerolith.functions.times import day_timestamp, hour_start, local_clock, local_day

_TIE_BITS = 26  # 8.64e10 microseconds of a day need 37 of the 63 bits


def _first_coordinates(order: Column, latitude: str = "latitude", longitude: str = "longitude") -> list[Column]:
    """Coordinates of the earliest row that has them."""
    return [
        F.min_by(F.col(latitude), F.when(F.col(latitude).isNotNull(), order)).alias("latitude"),
        F.min_by(F.col(longitude), F.when(F.col(longitude).isNotNull(), order)).alias("longitude"),
    ]


def _order_within(clock: Column, unit: str, station: str | None) -> Column:
    """Position of a reading inside its hour or day as one BIGINT.

    Stations report at the same instants, so time alone does not decide who is first; the
    low bits come from a hash of the station.  A struct would say the same but is not a
    fixed-width buffer, and would make Spark sort all readings before aggregating them.
    """
    micros = (F.extract(F.lit("SECOND"), clock) * 1_000_000).cast("bigint")
    minutes = F.minute(clock) if unit == "hour" else F.hour(clock) * 60 + F.minute(clock)
    offset = minutes.cast("bigint") * 60_000_000 + micros
    if station is None:
        return offset
    tie = F.pmod(F.xxhash64(F.col(station)), F.lit(1 << _TIE_BITS))
    return offset * F.lit(1 << _TIE_BITS) + tie


def _bucketed(df: DataFrame, unit: str, ts: str, tz: str | None, source_tz: str | None, station: str | None) -> DataFrame:
    clock = local_clock(F.col(ts), tz, source_tz)
    bucket = (
        hour_start(F.col(ts), tz, source_tz) if unit == "hour" else day_timestamp(local_day(F.col(ts), tz, source_tz))
    )
    known = station if station in df.columns else None
    return df.withColumns({"_bucket": bucket, "_order": _order_within(clock, unit, known)})


def _grouped(df: DataFrame, keys: Sequence[str]):
    return df.groupBy(*keys, F.col("_bucket").alias("timestamp"))


# --- per station and hour ---------------------------------------------------------------


def station_hour_scalar(
    df: DataFrame, value: str, name: str, station: str = "station_name", ts: str = "timestamp",
    latitude: str | None = "latitude", longitude: str | None = "longitude",
    update: str | None = None, tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    """Mean and count per station and hour; coordinates and last update where known."""
    return _station_hour(
        df, [F.avg(value).alias(f"{name}_avg")], value, station, ts, latitude, longitude, update, tz, source_tz
    )


def station_hour_circular(
    df: DataFrame, value: str, name: str, station: str = "station_name", ts: str = "timestamp",
    latitude: str | None = "latitude", longitude: str | None = "longitude",
    update: str | None = None, tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    """Circular mean, circular spread and count per station and hour."""
    measures = [
        angles.circular_mean(F.col(value)).alias(f"{name}_avg"),
        angles.circular_std(F.col(value)).alias(f"{name}_std"),
    ]
    return _station_hour(df, measures, value, station, ts, latitude, longitude, update, tz, source_tz)


def _station_hour(df, measures, value, station, ts, latitude, longitude, update, tz, source_tz) -> DataFrame:
    aggregates = [*measures, F.count(value).alias("reading_count")]
    if latitude and longitude and {latitude, longitude} <= set(df.columns):
        aggregates += _first_coordinates(F.col("_order"), latitude, longitude)
    if update and update in df.columns:
        aggregates.append(F.max(update).alias("last_update"))
    return _grouped(_bucketed(df, "hour", ts, tz, source_tz, None), [station]).agg(*aggregates)


# --- per region and hour / day ----------------------------------------------------------


def region_hour_scalar(
    df: DataFrame, value: str, name: str | None = None, ts: str = "timestamp", station: str | None = "station_id",
    tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    name = name or value
    return _grouped(_bucketed(df, "hour", ts, tz, source_tz, station), ["region"]).agg(
        F.avg(value).alias(f"{name}_avg"),
        F.count(value).alias("reading_count"),
        *_first_coordinates(F.col("_order")),
    )


def region_day_scalar(
    df: DataFrame, value: str, name: str | None = None, ts: str = "timestamp", station: str | None = "station_id",
    tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    """Mean, min, max and sample deviation per region and local day, from single readings."""
    name = name or f"{value}_avg"
    return _grouped(_bucketed(df, "day", ts, tz, source_tz, station), ["region"]).agg(
        F.avg(value).alias(f"{name}_mean"),
        F.min(value).alias(f"{name}_min"),
        F.max(value).alias(f"{name}_max"),
        F.stddev_samp(value).alias(f"{name}_std"),
        *_first_coordinates(F.col("_order")),
    )


def region_hour_circular(
    df: DataFrame, value: str, name: str | None = None, ts: str = "timestamp", station: str | None = "station_id",
    tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    name = name or value
    return _grouped(_bucketed(df, "hour", ts, tz, source_tz, station), ["region"]).agg(
        angles.circular_mean(F.col(value)).alias(f"{name}_avg"),
        angles.circular_std(F.col(value)).alias(f"{name}_std"),
        F.count(value).alias("reading_count"),
        *_first_coordinates(F.col("_order")),
    )


def region_day_circular(
    df: DataFrame, value: str, name: str | None = None, ts: str = "timestamp", station: str | None = "station_id",
    tz: str | None = None, source_tz: str | None = None,
) -> DataFrame:
    """Circular mean and spread, with plain minimum and maximum, per region and local day."""
    name = name or f"{value}_avg"
    return _grouped(_bucketed(df, "day", ts, tz, source_tz, station), ["region"]).agg(
        angles.circular_mean(F.col(value)).alias(f"{name}_mean"),
        angles.circular_std(F.col(value)).alias(f"{name}_std"),
        F.min(value).alias(f"{name}_min"),
        F.max(value).alias(f"{name}_max"),
        *_first_coordinates(F.col("_order")),
    )


def region_day_linear(
    hourly: DataFrame, value: str, ts: str = "timestamp", tz: str | None = None, source_tz: str | None = None
) -> DataFrame:
    """Plain daily statistics of hourly values, also for angles (the backfill's definition)."""
    return _grouped(_bucketed(hourly, "day", ts, tz, source_tz, None), ["region"]).agg(
        F.avg(value).alias(f"{value}_mean"),
        F.max(value).alias(f"{value}_max"),
        F.min(value).alias(f"{value}_min"),
        F.stddev_samp(value).alias(f"{value}_std"),
    )


def region_coordinates(df: DataFrame, ts: str = "timestamp", station: str = "station_id") -> DataFrame:
    """Coordinates of the earliest located reading of each region.

    Stations are folded first, so the ordered comparison sees one row per station.
    """
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    per_station = located.groupBy("region", station).agg(
        F.min(ts).alias("_since"), *_first_coordinates(F.col(ts))
    )
    order = F.struct("_since", station)
    return per_station.groupBy("region").agg(
        F.min_by("latitude", order).alias("latitude"), F.min_by("longitude", order).alias("longitude")
    )


def daily_index(
    df: DataFrame, value: str = "pm25", ts: str = "timestamp", tz: str | None = None, source_tz: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Daily air-quality index: hourly concentrations to index values, mean, half-even rounding."""
    index = concentration_to_index(F.col(value), strict=strict)
    return _grouped(_bucketed(df, "day", ts, tz, source_tz, None), ["region"]).agg(
        F.bround(F.avg(index), 0).alias("pm25")
    )


# --- one scan for both cadences ---------------------------------------------------------


def hour_states(
    df: DataFrame, value: str, ts: str = "timestamp", station: str | None = "station_id",
    tz: str | None = None, source_tz: str | None = None, circular: bool = False,
) -> DataFrame:
    """Mergeable aggregate states per region and local hour.

    Hourly *and* daily tables derive from these, so raw readings are scanned once.
    """
    state = [
        F.count(value).alias("n"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
        F.min("_order").alias("first_order"),
        *_first_coordinates(F.col("_order")),
    ]
    if circular:
        state += [angles.sine_sum(F.col(value)).alias("sin_sum"), angles.cosine_sum(F.col(value)).alias("cos_sum")]
    else:
        state += [F.avg(value).alias("mean"), F.var_pop(value).alias("var")]
    return _grouped(_bucketed(df, "hour", ts, tz, source_tz, station), ["region"]).agg(*state)


def hours_from_states(states: DataFrame, name: str, circular: bool = False) -> DataFrame:
    measures = (
        [
            angles.circular_mean_of_sums(F.col("sin_sum"), F.col("cos_sum")).alias(f"{name}_avg"),
            angles.circular_std_of_sums(F.col("sin_sum"), F.col("cos_sum"), F.col("n")).alias(f"{name}_std"),
        ]
        if circular
        else [F.col("mean").alias(f"{name}_avg")]
    )
    return states.select("region", "timestamp", *measures, F.col("n").alias("reading_count"), "latitude", "longitude")


def days_from_states(states: DataFrame, name: str, circular: bool = False) -> DataFrame:
    """Merge hour states into days; equal to rolling the readings up directly."""
    day = day_timestamp(F.to_date("timestamp"))
    # At most 24 states meet per region and day, so a wider ordering key costs nothing here.
    order = F.struct("timestamp", "first_order")
    coordinates = [
        F.min_by("latitude", F.when(F.col("latitude").isNotNull(), order)).alias("latitude"),
        F.min_by("longitude", F.when(F.col("longitude").isNotNull(), order)).alias("longitude"),
    ]
    grouped = states.groupBy("region", day.alias("_day"))
    low, high = F.min("low").alias(f"{name}_avg_min"), F.max("high").alias(f"{name}_avg_max")
    if circular:
        sin_sum, cos_sum, n = F.sum("sin_sum"), F.sum("cos_sum"), F.sum("n")
        out = grouped.agg(
            angles.circular_mean_of_sums(sin_sum, cos_sum).alias(f"{name}_avg_mean"),
            angles.circular_std_of_sums(sin_sum, cos_sum, n).alias(f"{name}_avg_std"),
            low, high, *coordinates,
        )
    else:
        n, mean = F.col("n"), F.col("mean")
        sums = grouped.agg(
            F.sum(n).alias("_n"), F.sum(n * mean).alias("_s"), F.sum(n * F.col("var")).alias("_within"),
            F.sum(n * mean * mean).alias("_q"), low, high, *coordinates,
        )
        total_mean = F.col("_s") / F.col("_n")
        between = F.greatest(F.lit(0.0), F.col("_q") - F.col("_n") * total_mean * total_mean)
        deviation = F.when(F.col("_n") > 1, F.sqrt((F.col("_within") + between) / (F.col("_n") - 1)))
        out = sums.select(
            "region", "_day", total_mean.alias(f"{name}_avg_mean"), f"{name}_avg_min", f"{name}_avg_max",
            deviation.alias(f"{name}_avg_std"), "latitude", "longitude",
        )
    return out.withColumnRenamed("_day", "timestamp")


# --- per station ------------------------------------------------------------------------


def station_summary_scalar(hourly: DataFrame, value: str, station: str = "station_name") -> DataFrame:
    """Period, count, coordinates and mean/min/max of each station's hourly values."""
    return hourly.groupBy(station).agg(
        F.min("timestamp").alias("start_date"),
        F.max("timestamp").alias("end_date"),
        F.count("timestamp").alias("total_hours"),
        *_first_coordinates(F.col("timestamp")),
        F.avg(value).alias("mean"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )


def station_summary_circular(
    hourly: DataFrame, direction: str, spread: str, station: str = "station_name"
) -> DataFrame:
    return hourly.groupBy(station).agg(
        F.min("timestamp").alias("start_date"),
        F.max("timestamp").alias("end_date"),
        F.count("timestamp").alias("total_hours"),
        *_first_coordinates(F.col("timestamp")),
        angles.circular_mean(F.col(direction)).alias("overall_mean"),
        F.avg(spread).alias("mean_spread"),
    )


def distinct_count(df: DataFrame, column: str, keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.groupBy(*keys).agg(count.alias(f"distinct_{column}"))


def period(df: DataFrame, keys: Sequence[str], ts: str = "timestamp") -> DataFrame:
    """First and last day and row count per group."""
    return df.groupBy(*keys).agg(
        F.to_date(F.min(ts)).alias("first_day"),
        F.to_date(F.max(ts)).alias("last_day"),
        F.count(F.lit(1)).alias("rows"),
    )


# --- whole-table forms ------------------------------------------------------------------


def with_overall_spread(df: DataFrame, direction: str, out: str = "wind_direction_std") -> DataFrame:
    """Circular spread over *all* rows, put on every row (one scalar, computed once)."""
    overall = df.agg(angles.circular_std(F.col(direction)).alias("s")).scalar()
    return df.withColumn(out, overall)


def most_frequent(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Most frequent value per group, the smallest on a tie.

    Counted per (group, value) first: the built-in ``mode`` keeps all values of a group in
    one buffer, which does not hold for a hot group.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(
        F.min_by(column, F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v"))).alias(out)
    )


def weather_day(
    df: DataFrame, keys: Sequence[str], temperature: str, precipitation: str, speed: str, direction: str
) -> DataFrame:
    """Mean temperature, total precipitation, top wind speed and dominant direction per group."""
    measures = df.groupBy(*keys).agg(
        F.avg(temperature).alias("temperature_2m_mean"),
        F.sum(precipitation).alias("precipitation_sum"),
        F.max(speed).alias("wind_speed_10m_max"),
    )
    dominant = most_frequent(df, keys, direction, "wind_direction_10m_dominant")
    return measures.join(dominant, list(keys), "left")
