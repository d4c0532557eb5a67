"""Landed JSON documents: readers and the flattening of their nested shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.constants import REGIONS
from aerolith.functions.airquality import concentration_to_index
from aerolith.functions.geo import centroid_latitude, centroid_longitude
from aerolith.functions.text import to_number
from aerolith.functions.times import from_unix_seconds, parse_instant, regular_times

WIDE_REGIONS = (*REGIONS, "national")


_CORRUPT = "_corrupt_record"


def _json(spark: SparkSession, path, schema: str, multiline: bool) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def _pages(spark: SparkSession, path, schema: str, multiline: bool) -> DataFrame:
    reader = spark.read.schema(f"{schema}, {_CORRUPT} string").option("columnNameOfCorruptRecord", _CORRUPT)
    return reader.option("multiLine", multiline).json(path).withColumn("file", F.col("_metadata.file_name"))


def _sound(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col(_CORRUPT).isNull() & (F.coalesce("code", F.lit(0)) == 0)).drop(_CORRUPT)


def read_station_pages(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Pages of station readings; pages that report an error or can't be parsed are in ``rejected_pages``."""
    return _sound(_pages(spark, path, schemas.STATION_PAGE, multiline))


def read_region_pages(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    return _sound(_pages(spark, path, schemas.REGION_PAGE, multiline)).drop("file")


def rejected_pages(spark: SparkSession, path, schema: str = schemas.STATION_PAGE, multiline: bool = False) -> DataFrame:
    """file, reason (``corrupt`` or the error code), record: what the page readers leave out."""
    pages = _pages(spark, path, schema, multiline)
    corrupt = F.col(_CORRUPT).isNotNull()
    reason = F.when(corrupt, "corrupt").otherwise(F.concat(F.lit("code "), F.col("code").cast("string")))
    bad = pages.select("file", reason.alias("reason"), F.coalesce(_CORRUPT, "errorMsg").alias("record"), corrupt.alias("c"), "code")
    return bad.filter(F.col("c") | (F.coalesce("code", F.lit(0)) != 0)).drop("c", "code")


def read_weather_arrays(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    return _json(spark, path, schemas.WEATHER_ARRAYS, multiline)


def read_forecast_blocks(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    return _json(spark, path, schemas.FORECAST_BLOCK, multiline)


def read_sensor_feed(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    return _json(spark, path, schemas.SENSOR_FEED, multiline)


def station_readings(pages: DataFrame, value: str = "value") -> DataFrame:
    """page -> reading -> point rows (timestamp, station_id, value); bad numbers become NULL."""
    lists = pages.select(F.explode(F.coalesce("data.readings", "data.items")).alias("reading"))
    points = lists.select("reading.timestamp", F.explode("reading.data").alias("point"))
    return points.select(
        parse_instant(F.col("timestamp")).alias("timestamp"),
        F.col("point.stationId").alias("station_id"),
        to_number(F.col("point.value")).alias(value),
    )


def station_mentions(pages: DataFrame, day: Column, page_order: Column) -> DataFrame:
    """Stations listed on each page, with what decides which mention wins."""
    listed = pages.select(day.alias("day"), page_order.alias("page"), F.posexplode("data.stations").alias("pos", "s"))
    return listed.select(
        "day",
        F.struct("page", "pos").alias("page"),
        F.col("s.id").alias("id"),
        F.col("s.name").alias("name"),
        F.col("s.deviceId").alias("device_id"),
        F.col("s.location.latitude").alias("latitude"),
        F.col("s.location.longitude").alias("longitude"),
    )


def _region_items(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode("data.items").alias("item")).select(
        parse_instant(F.col("item.timestamp")).alias("timestamp"),
        F.try_to_timestamp("item.date").cast("date").alias("date"),
        parse_instant(F.col("item.updatedTimestamp")).alias("updated_timestamp"),
        F.col("item.readings.pm25_one_hourly").alias("readings"),
    )


def region_readings(pages: DataFrame, regions: Sequence[str] = REGIONS, value: str = "pm25") -> DataFrame:
    """One row per item and listed region; other keys of the map (a national value) are dropped."""
    entries = _region_items(pages).select("timestamp", F.explode("readings").alias("region", "text"))
    return entries.filter(F.col("region").isin(*regions)).select(
        "timestamp", "region", to_number(F.col("text")).alias(value)
    )


def region_readings_wide(pages: DataFrame, regions: Sequence[str] = WIDE_REGIONS) -> DataFrame:
    return _region_items(pages).select(
        "timestamp", "date", "updated_timestamp", *[to_number(F.col("readings")[r]).alias(r) for r in regions]
    )


def wide_to_long(
    wide: DataFrame, ids: Sequence[str] = ("timestamp", "date"), regions: Sequence[str] = REGIONS,
    value: str = "pm25", as_index: bool = True,
) -> DataFrame:
    """One row per region with a value, converted to the index unless told otherwise."""
    long = wide.unpivot(list(ids), list(regions), "region", value).dropna(subset=[value])
    return long.withColumn(value, concentration_to_index(F.col(value))) if as_index else long


def zip_arrays(df: DataFrame, parent: str, fields: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows from parallel arrays inside struct ``parent``; shorter arrays end in NULLs."""
    zipped = F.arrays_zip(*[F.col(f"{parent}.{f}").alias(f) for f in fields])
    return df.select(*keep, F.explode(zipped).alias("_row")).select(
        *keep, *[F.col("_row")[f].alias(f) for f in fields]
    )


def weather_days(documents: DataFrame, city: str) -> DataFrame:
    fields = ("time", "temperature_2m_mean", "precipitation_sum", "wind_speed_10m_max", "wind_direction_10m_dominant")
    rows = zip_arrays(documents, "daily", fields)
    return rows.select(F.try_to_timestamp("time").cast("date").alias("date"), *fields[1:], F.lit(city).alias("city"))


def weather_hours(documents: DataFrame) -> DataFrame:
    fields = ("time", "temperature_2m", "precipitation", "wind_speed_10m", "wind_direction_10m")
    rows = zip_arrays(documents, "hourly", fields)
    return rows.withColumn("time", F.try_to_timestamp("time"))


def unix_series(df: DataFrame, seconds: str, values: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows from an array of unix seconds and arrays of values beside it."""
    zipped = F.arrays_zip(*[F.col(c) for c in (seconds, *values)])
    return df.select(*keep, F.explode(zipped).alias("_row")).select(
        *keep, from_unix_seconds(F.col("_row")[seconds]).alias("timestamp"), *[F.col("_row")[v].alias(v) for v in values]
    )


def forecast_hours(blocks: DataFrame) -> DataFrame:
    """Rows of hourly forecast from (start, end, interval) and value arrays; end excluded."""
    times = regular_times(F.col("start_s"), F.col("end_s"), F.col("interval_s"))
    rows = blocks.select("*", F.posexplode(times).alias("_i", "_s"))
    return rows.select(
        "region",
        from_unix_seconds(F.col("_s")).alias("timestamp"),
        F.get("temperature_2m", F.col("_i")).alias("air_temperature_avg"),
        F.get("wind_speed_10m", F.col("_i")).alias("wind_speed_avg"),
        F.get("wind_direction_10m", F.col("_i")).alias("wind_direction_avg"),
        F.lit(60).cast("bigint").alias("reading_count"),
        centroid_latitude(F.col("region")).alias("latitude"),
        centroid_longitude(F.col("region")).alias("longitude"),
    )


def feed_pm25(feed: DataFrame, city: str, day: Column) -> DataFrame:
    """Today's value per sensor; a feed without PM2.5 gives a missing value."""
    return feed.filter(F.col("status") == "ok").select(
        day.alias("date"),
        F.try_element_at("data.iaqi", F.lit("pm25"))["v"].cast("float").alias("pm25"),
        F.lit(city).alias("city"),
        "sensor_id",
    )


def feed_pollutants(feed: DataFrame, pollutants: Sequence[str]) -> DataFrame:
    """One column ``iaqi_<pollutant>`` per listed pollutant, missing where a feed lacks it.

    The list is an argument: a schema must not depend on what happens to arrive.
    """
    return feed.filter(F.col("status") == "ok").select(
        "sensor_id",
        parse_instant(F.col("data.time.iso")).alias("ts"),
        F.col("data.aqi").alias("aqi"),
        F.col("data.dominentpol").alias("dominentpol"),
        *[F.try_element_at("data.iaqi", F.lit(p))["v"].alias(f"iaqi_{p}") for p in pollutants],
    )


def feed_pollutants_long(feed: DataFrame) -> DataFrame:
    """(sensor, time, pollutant, value) rows, for whatever pollutants the feeds carry."""
    return feed.filter(F.col("status") == "ok").select(
        "sensor_id",
        parse_instant(F.col("data.time.iso")).alias("ts"),
        F.explode("data.iaqi").alias("pollutant", "reading"),
    ).select("sensor_id", "ts", "pollutant", F.col("reading.v").alias("value"))
