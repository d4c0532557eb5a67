"""The corpus pipeline: language ID, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``docs``.  ``run`` writes each stage's rows below the shared folder and reads them
again for the next, so that no stage is computed twice and a lost executor costs one stage's task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import decontaminate, lang_id, packing, secrets, simhash
from aerolith.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null texts and texts without letters go."""
    return lang_id.readable(docs, lang_id.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages.

    Rows are told apart by their text, not by their id: ids may repeat or be null, and equal texts share a verdict.
    """
    text = F.xxhash64("text")
    found = decontaminate.contaminated(docs.select(text.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = stored(found.select(F.col("doc_id").alias("_leak")).distinct(), "leaks")
    return docs.join(leaks, text == F.col("_leak"), "left_anti")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact(docs, secrets.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's pieces lie in sequences of 2048 tokens."""
    return packing.pack(docs, payload=F.crc32("ids"), most_words=200_000).withColumnRenamed("ids", "ids_crc32")


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secret_scan),
    ("best_fit_packing", pack),
]

#: Byte networks, tokenizers and alignments are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
