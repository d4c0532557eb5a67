import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def made(spark):
    """doc_id, text with nulls, empty and very long texts, repeated rows and ids, and clashing extra columns."""
    long = " ".join(f"word{i % 7919} of" for i in range(60_000))
    rows = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank today"),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today"),
        (3, None), (4, ""), (5, "   \n\t "), (6, "12345 ... !!"), (7, long), (8, "naïve façade — 日本語 😀 <|endoftext|> x"),
        (9, "one"), (9, "one"), (None, "a null id with some words"), (10, " two  spaces \n\n and lines\n"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("score", "fp", "ids", "length", "list", "gram", "key", "n", "words", "component_id", "spans"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture()
def nothing(spark, made):
    return made.limit(0)


@pytest.fixture(scope="session", autouse=True)
def _one_thread():
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
