"""Stored series: base rows beside their features, and refreshing what a change influences.

The base table ``<name>_base`` keeps every row of a series, complete or not, so that windows can
look back over rows whose own features are incomplete, and short deliveries build up a history.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolith.operators.features import SERIES, add_calendar, table_features
from aerolith.schemas import FEATURE_TABLES, TableSpec
from aerolith.sinks.tables import upsert
from aerolith.sources.tables import PERIOD, read_stored, read_table, table_exists


def base_spec(table: str) -> TableSpec:
    spec = FEATURE_TABLES[table]
    return replace(spec, name=f"{spec.name}_base", description=f"Base rows of {spec.name}", comments={})


def dated(df: DataFrame, table: str, tz: str | None = None, source_tz: str | None = None) -> DataFrame:
    return add_calendar(df, with_hour=SERIES[table].unit == "h", tz=tz, source_tz=source_tz)


def store_series(
    spark: SparkSession, base: DataFrame, table: str, root: str, tz: str | None = None, source_tz: str | None = None
) -> bool:
    """Store base rows, merged with stored ones by key, and the features of every row that they influence."""
    return merge_series(base, table, root, base.columns, tz, source_tz)


def _needed_periods(base: DataFrame, spans: DataFrame, spec: TableSpec, back: int) -> DataFrame:
    """(region, period) folders of each changed region that hold its changes and ``back`` rows on both sides.

    Rows are counted by folder, which needs no column of the files.
    """
    sizes = base.groupBy("region", PERIOD).agg(F.count("*").alias("_n"))
    spans = spans.select(
        F.col("region").alias("_region"), F.date_format("_from", spec.period).alias("_first"), F.date_format("_to", spec.period).alias("_last")
    )
    sizes = sizes.join(spans, F.col("region").eqNullSafe(F.col("_region")))
    newer = Window.partitionBy("region").orderBy(F.desc(PERIOD)).rowsBetween(Window.unboundedPreceding, -1)
    older = Window.partitionBy("region").orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, -1)
    between_first = F.when(F.col(PERIOD) < F.col("_first"), F.col("_n")).otherwise(0)
    between_last = F.when(F.col(PERIOD) > F.col("_last"), F.col("_n")).otherwise(0)
    counted = sizes.withColumns(
        {"_before": F.coalesce(F.sum(between_first).over(newer), F.lit(0)), "_after": F.coalesce(F.sum(between_last).over(older), F.lit(0))}
    )
    wanted = (
        F.col(PERIOD).between(F.col("_first"), F.col("_last"))
        | ((F.col(PERIOD) < F.col("_first")) & (F.col("_before") < back))
        | ((F.col(PERIOD) > F.col("_last")) & (F.col("_after") < back))
    )
    return counted.where(wanted).select(F.col("region").alias("_region"), F.col(PERIOD).alias("_period"))


def merge_series(
    changed: DataFrame, table: str, root: str, base_columns: Sequence[str], tz: str | None = None, source_tz: str | None = None
) -> bool:
    """Merge changed base rows into a stored series and refresh the rows they influence.

    A row's features look back over ``spec.back`` rows of its region, so a change reaches so many rows
    ahead.  Exactly these are computed anew, from the base rows; those that are incomplete now are
    removed, all others stay as they are.
    """
    spark = changed.sparkSession
    spec, base, back = FEATURE_TABLES[table], base_spec(table), SERIES[table].back
    changed = changed.select(*base_columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if changed.isEmpty():
            return False
        if not table_exists(spark, root, base.name, base.version) and table_exists(spark, root, spec.name, spec.version):
            # A table from before base rows were kept: its own rows are all there is.
            upsert(read_table(spark, root, spec.name, spec.version, base_columns), base, root)
        upsert(changed, base, root)
        spans = changed.groupBy("region").agg(F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to"))
        stored = read_stored(spark, root, base.name, base.version)
        periods = _needed_periods(stored, spans, base, back)
        here = F.col("region").eqNullSafe(F.col("_region")) & (F.col(PERIOD) == F.col("_period"))
        rows = stored.join(periods, here, "left_semi").drop(PERIOD)
        spans = spans.withColumnRenamed("region", "_region")
        rows = rows.join(spans, F.col("region").eqNullSafe(F.col("_region"))).drop("_region")
        # One row per region and hour, a few periods: the window is bounded by the calendar.
        later = F.when(F.col("timestamp") > F.col("_to"), 1).otherwise(0)
        ordered = Window.partitionBy("region").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_later", F.sum(later).over(ordered)).where(F.col("_later") <= back)
        influenced = F.col("timestamp") >= F.col("_from")
        features = table_features(dated(rows.select(*base_columns), table, tz, source_tz), table)
        spans_again = spans.select("_region", "_from")
        fresh = features.join(spans_again, F.col("region").eqNullSafe(F.col("_region"))).where(influenced).drop("_region", "_from")
        return upsert(fresh, spec, root, remove=rows.where(influenced).select(*spec.keys))
    finally:
        changed.unpersist()
