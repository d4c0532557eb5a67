"""CSV sources."""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.constants import DUMP_COLUMNS_TO_DROP, EARLIEST_DAY
from aerolith.functions.text import to_number
from aerolith.functions.times import parse_day, parse_instant


_CORRUPT = "_corrupt_line"


_LISTING, _LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism", threading.Lock()


@contextmanager
def _listing(spark: SparkSession):
    """Folders are listed by a few tasks a core: a task each, as is usual below 10,000 folders, costs far more than its list."""
    with _LISTERS:
        before = spark.conf.get(_LISTING)
        spark.conf.set(_LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
        try:
            yield
        finally:
            spark.conf.set(_LISTING, before)


def _csv(spark: SparkSession, path, schema: str, pattern: str | None = None, mode: str = "PERMISSIVE", **options):
    reader = spark.read.schema(schema).option("header", True).option("mode", mode).option("enforceSchema", True)
    for key, value in options.items():
        reader = reader.option(key, value)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    with _listing(spark):
        return reader.csv(path)


def read_reading_dump(spark: SparkSession, path, value: str = "reading_value", mode: str = "PERMISSIVE") -> DataFrame:
    """A yearly dump of single readings, typed, without the columns no rollup uses."""
    dump = _csv(spark, path, schemas.READING_DUMP, mode=mode).drop(*DUMP_COLUMNS_TO_DROP)
    return dump.withColumns(
        {
            "timestamp": parse_instant(F.col("timestamp")),
            "reading_update_timestamp": parse_instant(F.col("reading_update_timestamp")),
            "reading_value": to_number(F.col("reading_value")),
        }
    ).withColumnsRenamed({"reading_value": value, "location_latitude": "latitude", "location_longitude": "longitude"})


def read_station_files(
    spark: SparkSession, directory, schema: str = schemas.STATION_HOURLY_SPEED, pattern: str | None = None
) -> DataFrame:
    """All station files of a folder as one table; unreadable lines have no station and go."""
    rows = _csv(spark, directory, schema, pattern).filter(F.col("station_name").isNotNull())
    return rows.withColumns(
        {"timestamp": parse_instant(F.col("timestamp")), "last_update": parse_instant(F.col("last_update"))}
    )


def rejected_lines(
    spark: SparkSession, directory, schema: str = schemas.STATION_HOURLY_SPEED, pattern: str | None = None,
    required: str = "station_name",
) -> DataFrame:
    """file, reason, record of the lines that ``read_station_files`` leaves out or reads in part.

    ``corrupt``: more or fewer fields than columns, or a field of another type; ``no <required>``: a whole line
    without that value, as the fields that were read.
    """
    rows = _csv(spark, directory, f"{schema}, {_CORRUPT} string", pattern, columnNameOfCorruptRecord=_CORRUPT)
    fields = [f.name for f in rows.schema.fields if f.name != _CORRUPT]
    corrupt, lacking = F.col(_CORRUPT).isNotNull(), F.col(required).isNull()
    reason = F.when(corrupt, "corrupt").otherwise(f"no {required}")
    record = F.coalesce(F.col(_CORRUPT), F.concat_ws(",", *[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]))
    # A line is judged as a whole: the condition on the record has all columns parsed, whichever a reader uses.
    bad = (corrupt | lacking) & (F.length(record) >= 0)
    found = rows.select(F.col("_metadata.file_name").alias("file"), reason.alias("reason"), record.alias("record"), bad.alias("_bad"))
    return found.filter("_bad").drop("_bad")


def read_yearly_stations(
    spark: SparkSession, directories: dict[str, str], schema: str = schemas.STATION_HOURLY_SPEED,
    pattern: str | None = None,
) -> DataFrame:
    """Station files of several years, tagged with their year."""
    out = None
    for year, directory in directories.items():
        part = read_station_files(spark, directory, schema, pattern).withColumn("year", F.lit(year))
        out = part if out is None else out.unionByName(part)
    return out


def _region_from_file_name() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), r"^([A-Za-z]+)-", 1)


def read_region_hourly(spark: SparkSession, directory, pattern: str | None = None) -> DataFrame:
    """Hourly values of all regions; the region is the first part of the file name."""
    rows = _csv(spark, directory, schemas.REGION_HOURLY, pattern).withColumn("region", _region_from_file_name())
    return rows.select(
        parse_instant(F.col("timestamp")).alias("timestamp"), "region", to_number(F.col("pm25")).alias("pm25")
    )


def read_region_daily(spark: SparkSession, directory, pattern: str | None = None) -> DataFrame:
    """Daily values of all regions, blanks around headers and values allowed."""
    rows = _csv(
        spark, directory, schemas.REGION_DAILY, pattern, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    ).withColumn("region", _region_from_file_name())
    return rows.select(
        parse_day(F.col("date")).alias("date"), "region", to_number(F.col("pm25")).alias("pm25")
    )


def read_sensor_days(spark: SparkSession, path, sensor_id: int, city: str, since: str = EARLIEST_DAY) -> DataFrame:
    """One sensor's daily values since a first day; missing values are still in."""
    rows = _csv(
        spark, path, schemas.REGION_DAILY, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    return rows.select(
        parse_day(F.col("date")).alias("date"),
        to_number(F.col("pm25")).cast("float").alias("pm25"),
        F.lit(city).alias("city"),
        F.lit(sensor_id).alias("sensor_id"),
    ).filter(F.col("date") >= F.lit(since).cast("date"))


def read_station_metadata(spark: SparkSession, path) -> DataFrame:
    """Station dimension.  A missing file is an error, raised when the table is planned."""
    return _csv(spark, path, schemas.STATION_METADATA)
