"""Reading stored feature tables: ``<root>/<name>/v=<version>/``."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators.clean import describe_columns
from aerolith.schemas import FEATURE_TABLES, MONTHLY

PERIOD = "period_key"
DAILY_TABLES = ("pm25_daily", "wind_direction_daily", "wind_speed_daily", "air_temperature_daily")


def table_path(root: str, name: str, version: int) -> str:
    return f"{root.rstrip('/')}/{name}/v={version}"


def filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def table_exists(spark: SparkSession, root: str, name: str, version: int) -> bool:
    fs, path = filesystem(spark, table_path(root, name, version))
    return fs.exists(path) and any(s.getPath().getName()[0] not in "_." for s in fs.listStatus(path))


def latest_version(spark: SparkSession, root: str, name: str) -> int:
    fs, path = filesystem(spark, f"{root.rstrip('/')}/{name}")
    found = []
    if fs.exists(path):
        for status in fs.listStatus(path):
            match = re.fullmatch(r"v=(\d+)", status.getPath().getName())
            if match:
                found.append(int(match.group(1)))
    if not found:
        raise FileNotFoundError(f"no stored table {name!r} below {root}")
    return max(found)


def _partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the folder levels below a table, from the first folder of each level."""
    names, here = [], path
    while True:
        fs, current = filesystem(spark, here)
        below = [s.getPath().getName() for s in fs.listStatus(current) if s.isDirectory()]
        level = [n for n in below if "=" in n and not n.startswith("_")]
        if not level:
            return names
        names.append(level[0].split("=", 1)[0])
        here = f"{here}/{level[0]}"


def read_stored(spark: SparkSession, root: str, name: str, version: int) -> DataFrame:
    """The whole table with its period column.  Partition values are text, as they were written:
    read by inference, region "007" would come back as 7."""
    path = table_path(root, name, version)
    found = spark.read.parquet(path)
    names = [f.name for f in found.schema]
    folders = _partition_columns(spark, path)
    # Files keep the descriptions of their columns; those of the folders' names are the table's.
    known = FEATURE_TABLES[name].comments if name in FEATURE_TABLES else {}
    fields = [
        T.StructField(n, T.StringType()) if n in folders else T.StructField(n, found.schema[n].dataType, metadata=found.schema[n].metadata)
        for n in names
    ]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    return describe_columns(stored, {n: c for n, c in known.items() if n in folders})


def read_table(
    spark: SparkSession, root: str, name: str, version: int | None = None, columns: Sequence[str] | None = None,
    since=None, before=None, regions: Iterable[str] | None = None, event_time: str = "timestamp",
) -> DataFrame:
    """A stored table, or the part of it after ``since`` and before ``before``.

    Time bounds prune whole folders of files and are pushed into the Parquet scan besides.
    """
    version = latest_version(spark, root, name) if version is None else version
    df = read_stored(spark, root, name, version)
    for bound, is_lower in ((since, True), (before, False)):
        if bound is None:
            continue
        value = F.lit(bound).cast(df.schema[event_time].dataType)
        # A folder's name is as long as its period: a year, or a year and a month.
        period = F.substring(F.date_format(value, MONTHLY), F.lit(1), F.length(PERIOD))
        if is_lower:
            df = df.filter((F.col(PERIOD) >= period) & (F.col(event_time) >= value))
        else:
            df = df.filter((F.col(PERIOD) <= period) & (F.col(event_time) < value))
    if regions is not None:
        df = df.filter(F.col("region").isin(*regions))
    df = df.drop(PERIOD)
    return df.select(*columns) if columns else df


def daily_tables(spark: SparkSession, root: str, version: int | None = None, **bounds) -> dict[str, DataFrame]:
    """The four daily tables that training and forecasting read."""
    return {name: read_table(spark, root, name, version, **bounds) for name in DAILY_TABLES}
