"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings that are safe on any cluster.  Executor sizes and the number of shuffle
# partitions belong to the deployment; AQE coalesces the latter downwards at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "aerolith", master: str | None = None, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Where tables and state go that every executor must reach.

    ``spark.checkpoint.dir`` of the session, else its warehouse: every session has one, and a
    cluster keeps it on shared storage.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder in which long lineages are cut; set below the shared one if the session has none."""
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        current = f"{shared_folder(spark)}/aerolith/checkpoints"
        spark.sparkContext.setCheckpointDir(current)
    return current


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/aerolith/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Compute ``df`` once, reliably, when several branches of a plan read it.

    Used for rolled-up series, which are far smaller than the readings behind them.  The
    table lies in the shared folder, so a lost executor costs nothing but a re-read, and
    filters and column choices of later readers reach its scan.  ``by``: columns with few values
    whose rows go to folders of their own; a filter on them reads only these.
    """
    path = work_path(df.sparkSession, "stored")
    writer = df.repartition(*by).write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
