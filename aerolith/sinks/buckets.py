"""Tables that are stored ready to be joined: dealt to buckets by key and sorted in each."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from aerolith.session import work_path


def store_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """Write ``df`` as a table of the session's catalog, in as many files as buckets, and read it again.

    Tables of equal keys and numbers of buckets join on the keys without an exchange or a sort, again and again.
    A bucket should fit a task: some hundred MB.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *keys)  # a bucket's rows in one task, hence in one file, which stays sorted
    writer = rows.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", work_path(spark, table))
    writer.saveAsTable(table)
    return spark.table(table)


def join_bucketed(first: DataFrame, *others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Inner join of bucketed tables, bucket by bucket; a column that several have comes from the first."""
    out = first
    for other in others:
        repeated = [c for c in other.columns if c in out.columns and c not in on]
        out = out.join(other.drop(*repeated).hint("merge"), list(on))
    return out
