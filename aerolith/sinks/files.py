"""CSV exports: one folder per station or region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.text import safe_name


def write_station_csv(df: DataFrame, path: str, station: str = "station_name", order: str = "timestamp") -> None:
    """Sorted files per station under its file-name-safe name.

    Range partitioning on (station, time) keeps each file sorted, and lets a station with
    very many rows spread over several consecutive files.
    """
    named = df.withColumn("station", safe_name(F.col(station)))
    (
        named.repartitionByRange("station", order)
        .sortWithinPartitions("station", order)
        .write.mode("overwrite").partitionBy("station").option("header", True).csv(path)
    )


def write_region_csv(df: DataFrame, path: str, order: str = "timestamp") -> None:
    (
        df.repartitionByRange("region", order)
        .sortWithinPartitions("region", order)
        .write.mode("overwrite").partitionBy("region").option("header", True).csv(path)
    )


def write_small_csv(df: DataFrame, path: str) -> None:
    """A dimension or summary with one row per station: a plain CSV folder."""
    df.write.mode("overwrite").option("header", True).csv(path)
