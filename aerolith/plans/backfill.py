"""Historical backfill: yearly station files and regional files -> the eight tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.geo import nearest_region
from aerolith.operators import rollup
from aerolith.operators.features import add_calendar, seasonal_features, table_features
from aerolith.operators.joins import attach_coordinates
from aerolith.session import materialize


def region_hours(station_hours: DataFrame, measure: str, station: str = "station_name") -> DataFrame:
    """One row per region and hour from hourly station rows, as the table's key demands."""
    located = station_hours.withColumn("region", nearest_region(F.col("latitude"), F.col("longitude")))
    located = located.filter(F.col("region").isNotNull())
    if measure == "wind_direction":
        return rollup.region_hour_circular(located, f"{measure}_avg", measure, station=station)
    return rollup.region_hour_scalar(located, f"{measure}_avg", measure, station=station)


def region_days(station_hours: DataFrame, measure: str, station: str = "station_name", circular: bool = True) -> DataFrame:
    """Daily weather from hourly station rows; ``circular=False`` averages angles plainly."""
    located = station_hours.withColumn("region", nearest_region(F.col("latitude"), F.col("longitude")))
    located = located.filter(F.col("region").isNotNull())
    if measure == "wind_direction" and circular:
        return rollup.region_day_circular(located, f"{measure}_avg", f"{measure}_avg", station=station)
    days = rollup.region_day_linear(located, f"{measure}_avg")
    return attach_coordinates(days, rollup.region_coordinates(located, station=station))


def backfill_tables(
    pm25_hourly: DataFrame, pm25_daily: DataFrame, weather: dict[str, DataFrame], seasonal: bool = True,
    circular: bool = True,
) -> dict[str, DataFrame]:
    """Features of all tables.  ``weather``: measure -> hourly station rows.

    ``seasonal`` builds hourly features per hour of day (lag 1 = same hour, a day before).
    """
    hourly = {"pm25_hourly": pm25_hourly}
    daily = {"pm25_daily": pm25_daily}
    for measure, rows in weather.items():
        hourly[f"{measure}_hourly"] = materialize(region_hours(rows, measure))
        daily[f"{measure}_daily"] = materialize(region_days(rows, measure, circular=circular))
    out = {}
    for table, df in hourly.items():
        dated = add_calendar(df, with_hour=True)
        out[table] = seasonal_features(dated, table) if seasonal else table_features(dated, table)
    for table, df in daily.items():
        out[table] = table_features(add_calendar(df, with_hour=False), table)
    return out
