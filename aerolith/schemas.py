"""Explicit schemas of every source, and the layout of the stored feature tables."""

from __future__ import annotations

from dataclasses import dataclass, field

STATION_PAGE = """
code bigint, errorMsg string,
data struct<
  stations: array<struct<id: string, deviceId: string, name: string,
                         location: struct<latitude: double, longitude: double>>>,
  readings: array<struct<timestamp: string, data: array<struct<stationId: string, value: string>>>>,
  items: array<struct<timestamp: string, data: array<struct<stationId: string, value: string>>>>,
  paginationToken: string>
"""

REGION_PAGE = """
code bigint, errorMsg string,
data struct<
  items: array<struct<date: string, timestamp: string, updatedTimestamp: string,
                      readings: struct<pm25_one_hourly: map<string, string>>>>,
  paginationToken: string>
"""

READING_DUMP = """
date date, timestamp string, update_timestamp string, station_id string, station_name string,
station_device_id string, location_longitude double, location_latitude double, reading_update_timestamp string,
reading_value string, reading_type string, reading_unit string
"""

STATION_HOURLY_SPEED = """
timestamp string, station_id string, station_name string, wind_speed_avg double, reading_count bigint,
latitude double, longitude double, last_update string
"""

STATION_HOURLY_DIRECTION = """
timestamp string, station_id string, station_name string, wind_direction_avg double, wind_direction_std double,
reading_count bigint, latitude double, longitude double, last_update string
"""

STATION_HOURLY_TEMPERATURE = """
timestamp string, station_id string, station_name string, air_temperature_avg double, reading_count bigint,
latitude double, longitude double, last_update string
"""

STATION_METADATA = "id string, name string, device_id string, latitude double, longitude double"

REGION_HOURLY = "timestamp string, date string, pm25 string"

REGION_DAILY = "date string, pm25 string, pm10 string, o3 string, no2 string, so2 string, co string, psi string"

WEATHER_ARRAYS = """
daily struct<time: array<string>, temperature_2m_mean: array<double>, precipitation_sum: array<double>,
             wind_speed_10m_max: array<double>, wind_direction_10m_dominant: array<double>>,
hourly struct<time: array<string>, temperature_2m: array<double>, precipitation: array<double>,
              wind_speed_10m: array<double>, wind_direction_10m: array<double>>
"""

FORECAST_BLOCK = """
region string, start_s bigint, end_s bigint, interval_s bigint,
temperature_2m array<double>, wind_speed_10m array<double>, wind_direction_10m array<double>
"""

SENSOR_FEED = """
status string, sensor_id bigint,
data struct<aqi: int, dominentpol: string, time: struct<iso: string>, iaqi: map<string, struct<v: double>>>
"""


# Patterns of the period column; the leading letter keeps a year from reading as a number.
YEARLY = "'y'yyyy"
MONTHLY = "'y'yyyy-MM"


@dataclass(frozen=True)
class TableSpec:
    """A keyed, versioned feature table.

    Files are laid out by ``region`` (or the given columns) and calendar period, so that a
    daily upsert rewrites the current period of the touched regions and nothing else.
    Daily tables take a year per folder, hourly ones a month: 365 and about 730 rows per
    region, and far more where the partition column is finer than a region.
    """

    name: str
    version: int
    keys: tuple[str, ...]
    event_time: str = "timestamp"
    partition_by: tuple[str, ...] = ("region",)
    period: str = YEARLY
    description: str = ""
    comments: dict[str, str] = field(default_factory=dict)


_SERIES_KEY = ("region", "timestamp")

FEATURE_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("pm25_hourly", 4, _SERIES_KEY, period=MONTHLY, description="Hourly PM2.5 per region with features"),
        TableSpec("pm25_daily", 4, _SERIES_KEY, description="Daily PM2.5 index per region with features"),
        TableSpec("wind_speed_hourly", 4, _SERIES_KEY, period=MONTHLY, description="Hourly wind speed per region with features"),
        TableSpec("wind_speed_daily", 4, _SERIES_KEY, description="Daily wind speed per region with features"),
        TableSpec("wind_direction_hourly", 4, _SERIES_KEY, period=MONTHLY, description="Hourly wind direction with features"),
        TableSpec("wind_direction_daily", 4, _SERIES_KEY, description="Daily wind direction with features"),
        TableSpec("air_temperature_hourly", 4, _SERIES_KEY, period=MONTHLY, description="Hourly air temperature with features"),
        TableSpec("air_temperature_daily", 4, _SERIES_KEY, description="Daily air temperature with features"),
        TableSpec(
            "aq_predictions", 9, ("region", "timestamp", "days_before_forecast_day"),
            description="Air quality prediction monitoring",
        ),
        TableSpec(
            "air_quality", 1, ("city", "sensor_id", "date"), event_time="date", partition_by=("city",),
            description="Air quality characteristics of each day",
            comments={
                "date": "Day of the reading",
                "city": "City of the sensor",
                "pm25": "Fine particulate matter below 2.5 micrometres",
                "sensor_id": "Sensor that took the reading",
            },
        ),
        TableSpec(
            "weather", 1, ("city", "date"), event_time="date", partition_by=("city",),
            description="One row per city and day",
            comments={
                "date": "Day of the observation",
                "city": "City of the observation or forecast",
                "temperature_2m_mean": "Mean temperature of the day, degrees Celsius",
                "precipitation_sum": "Sum of rain and snow, mm",
                "wind_speed_10m_max": "Top wind speed 10 m above ground",
                "wind_direction_10m_dominant": "Most frequent wind direction, degrees",
            },
        ),
    )
}
