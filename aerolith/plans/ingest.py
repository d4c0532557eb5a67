"""The daily job: landed pages -> rollups -> history -> features -> stored tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.constants import LOCAL_ZONE
from aerolith.functions.airquality import concentration_to_index
from aerolith.functions.geo import nearest_region
from aerolith.functions.times import local_clock, to_instant
from aerolith.operators import rollup
from aerolith.operators.clean import valid_directions
from aerolith.operators.joins import station_lookup
from aerolith.operators.merge import merge_station_metadata
from aerolith.plans.series import store_series
from aerolith.session import materialize
from aerolith.sources import landing


def located_readings(pages: DataFrame, measure: str, unmatched: str = "null") -> DataFrame:
    """Flattened readings with region; readings of unknown stations are dropped or central."""
    readings = landing.station_readings(pages, measure).dropna(subset=["timestamp", measure])
    if measure == "wind_direction":
        readings = valid_directions(readings, measure)
    mentions = landing.station_mentions(pages, F.lit(0), F.col("file"))
    stations = merge_station_metadata(mentions)
    regions = station_lookup(readings, stations).withColumn(
        "region", nearest_region(F.col("latitude"), F.col("longitude"), unmatched=unmatched)
    )
    return regions.filter(F.col("region").isNotNull()).drop("station_name")


def _as_utc_hours(hourly: DataFrame, tz: str) -> DataFrame:
    # Hours are cut on the local clock and stored as UTC; days keep their local date.
    return hourly.withColumn("timestamp", to_instant(F.col("timestamp"), tz))


def weather_series(pages: DataFrame, measure: str, tz: str = LOCAL_ZONE, unmatched: str = "null"):
    """(hourly, daily) rollups of one weather measure from a single scan of its readings."""
    circular = measure == "wind_direction"
    states = materialize(
        rollup.hour_states(located_readings(pages, measure, unmatched), measure, tz=tz, circular=circular)
    )
    hourly = rollup.hours_from_states(states, measure, circular)
    return _as_utc_hours(hourly, tz), rollup.days_from_states(states, measure, circular)


def pm25_series(pages: DataFrame, tz: str = LOCAL_ZONE):
    """(hourly, daily) PM2.5: hourly as measured with its index beside it, daily as index."""
    readings = landing.region_readings(pages).dropna(subset=["timestamp", "pm25"])
    hourly = readings.select(
        "region", local_clock(F.col("timestamp"), "UTC").alias("timestamp"), "pm25",
        concentration_to_index(F.col("pm25")).alias("pm25_aqi"),
    )
    return hourly, rollup.daily_index(readings, tz=tz)


def forecast_series(blocks: DataFrame, tz: str = "UTC") -> dict[str, DataFrame]:
    """The six weather tables from forecast blocks.  Days are UTC days unless told otherwise."""
    hours = landing.forecast_hours(blocks)
    clock = hours.withColumn("timestamp", local_clock(F.col("timestamp"), "UTC"))
    base = ["region", "timestamp", "latitude", "longitude", "reading_count"]
    out = {}
    for measure in ("wind_speed", "air_temperature"):
        out[f"{measure}_hourly"] = clock.select(*base, f"{measure}_avg")
        out[f"{measure}_daily"] = rollup.region_day_scalar(hours, f"{measure}_avg", f"{measure}_avg", tz=tz)
    direction = clock.select(*base, "wind_direction_avg")
    out["wind_direction_hourly"] = rollup.with_overall_spread(direction, "wind_direction_avg")
    out["wind_direction_daily"] = rollup.region_day_circular(hours, "wind_direction_avg", "wind_direction_avg", tz=tz)
    return out


def store_features(
    spark: SparkSession, series: Mapping[str, DataFrame], root: str, calendar_zone: str | None = None
) -> dict[str, bool]:
    """Base rows merged with the stored ones, and the features of all rows that they influence, for each named table.

    Hourly rows are stored in UTC; ``calendar_zone`` names the zone of their hour column.
    """
    done = {}
    for table, fresh in series.items():
        zone = calendar_zone if table.endswith("hourly") else None
        done[table] = store_series(spark, fresh, table, root, tz=zone, source_tz="UTC" if zone else None)
    return done


def daily_ingest(
    spark: SparkSession, paths: Mapping[str, str], root: str, tz: str = LOCAL_ZONE,
    unmatched: str = "null", multiline: bool = False,
) -> dict[str, bool]:
    """Process one delivery.  ``paths``: landing folder of each of pm25, wind_speed,
    wind_direction, air_temperature (any may be missing)."""
    series: dict[str, DataFrame] = {}
    if "pm25" in paths:
        pages = landing.read_region_pages(spark, paths["pm25"], multiline)
        series["pm25_hourly"], series["pm25_daily"] = pm25_series(pages, tz)
    for measure in ("wind_speed", "wind_direction", "air_temperature"):
        if measure in paths:
            pages = landing.read_station_pages(spark, paths[measure], multiline)
            series[f"{measure}_hourly"], series[f"{measure}_daily"] = weather_series(pages, measure, tz, unmatched)
    return store_features(spark, series, root, calendar_zone=tz)


def forecast_ingest(
    spark: SparkSession, path: str, root: str, tz: str = "UTC", calendar_zone: str = LOCAL_ZONE
) -> dict[str, bool]:
    """Store the coming days' weather in the same tables as the observed one."""
    blocks = landing.read_forecast_blocks(spark, path)
    return store_features(spark, forecast_series(blocks, tz), root, calendar_zone=calendar_zone)
