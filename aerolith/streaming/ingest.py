"""Resumable ingestion of landed pages: the checkpoint remembers which files are done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.schemas import TableSpec
from aerolith.sinks.tables import upsert
from aerolith.sources.landing import region_readings, station_readings


def _pages(spark: SparkSession, landing: str, schema: str, files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(landing).filter(F.coalesce("code", F.lit(0)) == 0)


def stream_station_readings(
    spark: SparkSession, landing: str, value: str = "value", files_per_trigger: int | None = None
) -> DataFrame:
    return station_readings(_pages(spark, landing, schemas.STATION_PAGE, files_per_trigger), value)


def stream_region_readings(spark: SparkSession, landing: str, files_per_trigger: int | None = None) -> DataFrame:
    return region_readings(_pages(spark, landing, schemas.REGION_PAGE, files_per_trigger))


def keep_readings(readings: DataFrame, spec: TableSpec, root: str, checkpoint: str):
    """Merge arriving readings into a stored table by key; returns the running query.

    Nothing is too late: a reading is stored whenever it comes, and once however often it comes.
    A batch that is retried replaces its own rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, spec, root)

    return (
        readings.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
