"""Unions, de-duplication and the merge of yearly station tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.constants import STATION_FILE_COLUMNS
from aerolith.operators.clean import drop_existing, keep_existing


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Rows of all tables, columns matched by name; a column a table lacks is missing there."""
    out = first
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def union_history(
    fresh: DataFrame, history: DataFrame, keys: Sequence[str] = ("region", "timestamp"), mode: str = "key"
) -> DataFrame:
    """New rows with stored ones, without duplicates.

    ``key``: one row per key, the new one if both exist.  ``row``: only rows that agree in
    every column are duplicates, so a recomputed row stays beside the stored one.
    """
    if mode == "row":
        return union_all(fresh, history).distinct()
    if mode != "key":
        raise ValueError("mode is 'key' or 'row'")
    tagged = union_all(fresh.withColumn("_age", F.lit(0)), history.withColumn("_age", F.lit(1)))
    return keep_first(tagged, keys, ["_age"]).drop("_age")


def merge_yearly(
    df: DataFrame, year_rank: str = "year", columns: Sequence[str] = STATION_FILE_COLUMNS,
    station: str = "station_name", ts: str = "timestamp",
) -> DataFrame:
    """One series per station out of overlapping yearly ones; the earliest year wins.

    All stations in one job; rows without a station name belong to no series and go.
    """
    named = drop_existing(df.filter(F.col(station).isNotNull()), ["station_id"])
    return keep_existing(keep_first(named, [station, ts], [year_rank]), columns)


def merge_station_metadata(
    stations: DataFrame, fields: Sequence[str] = ("name", "device_id", "latitude", "longitude"),
    key: str = "id", day: str = "day", page_order: str = "page",
) -> DataFrame:
    """Station dimension from daily pages: first mention inside a day, latest day overall."""
    present = stations.filter(F.col(key).isNotNull())
    latest = keep_first(present, [key], [F.col(day).desc(), F.col(page_order)])
    return latest.select(key, *fields)
