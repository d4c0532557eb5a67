"""Hourly rollups over a stream of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions import angles
from aerolith.schemas import TableSpec
from aerolith.sinks.tables import upsert
from aerolith.sources.tables import read_table


def _measures(value: str, name: str, circular: bool) -> list[Column]:
    if circular:
        return [angles.circular_mean(F.col(value)).alias(f"{name}_avg"), angles.circular_std(F.col(value)).alias(f"{name}_std")]
    return [F.avg(value).alias(f"{name}_avg")]


def hourly_windows(
    readings: DataFrame, value: str, name: str, keys: Sequence[str] = ("region",), ts: str = "timestamp",
    delay: str = "2 hours", circular: bool = False,
) -> DataFrame:
    """Tumbling hours per key.  ``ts`` must be an instant: watermarks do not take zone-less times.

    Rows later than the delay are not counted here; ``keep_hours_current`` loses none.
    """
    grouped = readings.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("_hour"), *keys)
    hours = grouped.agg(*_measures(value, name, circular), F.count(value).alias("reading_count"))
    return hours.select(*keys, F.col("_hour.start").alias("timestamp"), *hours.columns[1 + len(keys):])


def keep_hours_current(
    readings: DataFrame, value: str, name: str, raw: TableSpec, hours: TableSpec, root: str, checkpoint: str,
    keys: Sequence[str] = ("region",), ts: str = "timestamp", circular: bool = False,
):
    """Stored hourly rollups that any reading, however late, brings up to date; returns the running query.

    A batch is merged into the table of readings, then the hours it touches are computed anew
    from that table and replace the stored ones.  ``raw`` names its keys and layout.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        if upsert(batch, raw, root):
            touched = batch.select(*keys, F.date_trunc("hour", ts).alias("_hour")).distinct()
            span = touched.agg(F.min("_hour").alias("low"), F.max("_hour").alias("high")).first()
            stored = read_table(batch.sparkSession, root, raw.name, raw.version, since=span.low, event_time=ts)
            rows = stored.where(F.col(ts) < F.lit(span.high) + F.expr("INTERVAL 1 HOUR"))
            rows = rows.withColumn("_hour", F.date_trunc("hour", ts)).join(touched, [*keys, "_hour"], "left_semi")
            grouped = rows.groupBy(*keys, F.col("_hour").alias("timestamp"))
            upsert(grouped.agg(*_measures(value, name, circular), F.count(value).alias("reading_count")), hours, root)
        batch.unpersist()

    return (
        readings.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_table_current(hours: DataFrame, spec: TableSpec, root: str, checkpoint: str):
    """Upsert changed hours into a stored table, batch by batch; returns the running query.

    Update mode emits an hour whenever it changes, so the table also shows hours that the
    watermark has not closed yet.  A batch that is retried replaces its own rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, spec, root)

    return (
        hours.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
