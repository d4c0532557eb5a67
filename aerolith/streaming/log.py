"""Append-only readings and hours: nothing that is stored is rewritten, and nothing is too late.

Arriving readings go to a log, a folder for each batch.  Readings in time feed a stateful stream:
duplicates go within the watermark, and an hour is written once, when the watermark has passed
its end.  The watermark is carried along in the log, so that a reading that the stream would drop
is known beforehand: it is kept apart as late, and the closed hours that late readings belong to
are computed anew from the log and written as a newer version.  Readers take an hour's newest.

A batch that is retried replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from aerolith.sources.tables import filesystem
from aerolith.streaming.rollup import _measures

DELAY = "2 HOURS"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, here = filesystem(spark, path)
    return fs.exists(here)


def append_to_log(readings: DataFrame, root: str, checkpoint: str, ts: str = "timestamp", delay: str = DELAY):
    """Write each batch to the log, readings behind the watermark apart; returns the running query.

    ``ts`` is an instant.  The watermark of a batch is the latest time of all batches before, less ``delay``.
    A reading without a time is late: no hour takes it.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        mark = watermark(spark, root, before=batch_id, delay=delay)
        late = F.lit(False) if mark is None else F.col(ts) < F.lit(mark)
        kinds = {"on_time": ~late & F.col(ts).isNotNull(), "late": late | F.col(ts).isNull()}
        for kind, rows in kinds.items():
            batch.filter(rows).write.mode("overwrite").parquet(f"{root}/{kind}/batch={batch_id}")
        batch.agg(F.max(ts).alias("latest")).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")
        batch.unpersist()

    return readings.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def watermark(spark: SparkSession, root: str, before: int | None = None, delay: str = DELAY):
    """The latest time of the batches (before ``before``) less the delay; None without any."""
    if not _exists(spark, f"{root}/marks"):
        return None
    marks = spark.read.schema("latest timestamp, batch long").parquet(f"{root}/marks")
    marks = marks if before is None else marks.filter(F.col("batch") < before)
    return marks.agg(F.max("latest") - F.expr(f"INTERVAL {delay}")).first()[0]


def read_log(spark: SparkSession, root: str, schema: StructType, key: Sequence[str], kinds: Sequence[str] = ("on_time", "late")) -> DataFrame:
    """The log's readings, each key once: as it came first."""
    parts = [
        spark.read.schema(StructType(schema.fields).add("batch", "long")).parquet(f"{root}/{kind}").withColumn("_kind", F.lit(kind))
        for kind in kinds if _exists(spark, f"{root}/{kind}")
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Copies may differ in other columns: those of a batch are put in order by their content.
    order = Window.partitionBy(*key).orderBy("batch", F.desc("_kind"), F.xxhash64(*schema.fieldNames()))
    return rows.withColumn("_copy", F.row_number().over(order)).filter("_copy = 1").select(*schema.fieldNames())


def close_hours(
    spark: SparkSession, root: str, checkpoint: str, schema: StructType, key: Sequence[str], value: str, name: str,
    keys: Sequence[str] = ("region",), ts: str = "timestamp", delay: str = DELAY, circular: bool = False,
):
    """Write each hour once, as soon as the watermark has passed its end; returns the running query.

    State holds the keys and hours within the delay, however long the stream.
    """
    rows = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1000)
    rows = rows.parquet(f"{root}/on_time").withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))
    grouped = rows.groupBy(F.window(ts, "1 hour").alias("_hour"), *keys)
    hours = grouped.agg(*_measures(value, name, circular), F.count(value).alias("reading_count"))
    hours = hours.select(*keys, F.col("_hour.start").alias("timestamp"), *hours.columns[1 + len(keys):])

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/hours/kind=closed/batch={batch_id}")

    return hours.writeStream.foreachBatch(store).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _versions(spark: SparkSession, path: str) -> int:
    """How many batches a folder holds."""
    fs, top = filesystem(spark, path)
    return sum(s.getPath().getName().startswith("batch=") for s in fs.listStatus(top)) if fs.exists(top) else 0


def correct_hours(
    spark: SparkSession, root: str, schema: StructType, key: Sequence[str], value: str, name: str,
    keys: Sequence[str] = ("region",), ts: str = "timestamp", delay: str = DELAY, circular: bool = False, after: int = -1,
) -> int | None:
    """Compute the closed hours anew that late readings of batches after ``after`` belong to; returns the version written.

    An hour that is still open is left to a later run: pass its batch again.
    """
    mark = watermark(spark, root, delay=delay)
    if mark is None or not _exists(spark, f"{root}/late"):
        return None
    late = spark.read.schema(StructType(schema.fields).add("batch", "long")).parquet(f"{root}/late")
    hour = F.date_trunc("hour", ts)
    touched = late.filter(F.col("batch") > after).select(*keys, hour.alias("_hour")).distinct()
    touched = touched.filter(F.col("_hour") + F.expr("INTERVAL 1 HOUR") <= F.lit(mark))
    span = touched.agg(F.min("_hour").alias("low"), F.max("_hour").alias("high")).first()
    if span.low is None:
        return None
    rows = read_log(spark, root, schema, key).filter((F.col(ts) >= F.lit(span.low)) & (F.col(ts) < F.lit(span.high) + F.expr("INTERVAL 1 HOUR")))
    same = [rows[k].eqNullSafe(touched[k]) for k in keys]
    rows = rows.withColumn("_at", hour).join(touched, [*same, F.col("_at") == F.col("_hour")], "left_semi")
    grouped = rows.groupBy(*keys, F.col("_at").alias("timestamp"))
    version = _versions(spark, f"{root}/hours/kind=corrected")
    out = grouped.agg(*_measures(value, name, circular), F.count(value).alias("reading_count"))
    out.write.mode("overwrite").parquet(f"{root}/hours/kind=corrected/batch={version}")
    return version


def read_hours(spark: SparkSession, root: str, keys: Sequence[str] = ("region",)) -> DataFrame:
    """The newest version of each closed hour."""
    hours = spark.read.parquet(f"{root}/hours")  # kind and batch are the folders' names
    measures = [c for c in hours.columns if c not in (*keys, "timestamp", "kind", "batch")]
    newest: Column = F.max_by(F.struct(*measures), F.struct((F.col("kind") == "corrected").alias("c"), F.col("batch").cast("long")))
    return hours.groupBy(*keys, "timestamp").agg(newest.alias("_row")).select(*keys, "timestamp", "_row.*")

