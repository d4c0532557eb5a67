"""Helpers of several operators: the shared folder, stored intermediate tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch are handled in groups of about so many characters, to bound memory.
SLICE_CHARS = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the warehouse, which every session has and executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used."""
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read again: computed once, and no executor's loss undoes it."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts, so that few texts at a time become Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grouped_by_size(texts: list[str], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of ``texts`` with about ``most`` characters each, one text at least."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def fit_fold(doc_id: str = "doc_id") -> Column:
    """True where crc32 of the id's decimal text is not divisible by 5; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 != 0, F.lit(False))
