"""Missing-value counts, expectations and gates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.constants import MAX_NULLS_PER_SENSOR


class QualityError(ValueError):
    """A table failed its expectations."""


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column as rows (column, missing), plus a total row."""
    names = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    total = sum((F.col(f"n{i}") for i in range(len(names))), F.lit(0))
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("missing")) for i, c in enumerate(names)]
    rows.append(F.struct(F.lit("(total)").alias("column"), total.cast("bigint").alias("missing")))
    return counts.select(F.inline(F.array(*rows)))


def check_minima(df: DataFrame, expectations: Sequence[tuple[str, float, float]]) -> DataFrame:
    """One row per expectation: the column's minimum must lie in (low, high].

    A column without values has no minimum and passes, as an empty delivery does.
    """
    minima = df.agg(*[F.min(c).cast("double").alias(f"m{i}") for i, (c, _, _) in enumerate(expectations)])
    rows = [
        F.struct(
            F.lit(column).alias("column"),
            F.col(f"m{i}").alias("observed"),
            F.lit(float(low)).alias("low"),
            F.lit(float(high)).alias("high"),
            F.coalesce((F.col(f"m{i}") > low) & (F.col(f"m{i}") <= high), F.lit(True)).alias("passed"),
        )
        for i, (column, low, high) in enumerate(expectations)
    ]
    return minima.select(F.inline(F.array(*rows)))


def require_minima(df: DataFrame, expectations: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Pass the table on, or raise with the failed expectations (a few rows at most)."""
    failed = check_minima(df, expectations).filter(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"min({r['column']}) = {r['observed']}" for r in failed))
    return df


def null_gate(df: DataFrame, key: str, column: str, limit: int = MAX_NULLS_PER_SENSOR) -> DataFrame:
    """Whether all sensors lack equally many values, and fewer than ``limit``."""
    per_key = df.groupBy(key).agg(F.count_if(F.col(column).isNull()).alias("missing"))
    return per_key.agg(
        F.min("missing").alias("least"),
        F.max("missing").alias("most"),
        (F.min("missing") == F.max("missing")).alias("equal"),
        (F.max("missing") < limit).alias("below_limit"),
    )


def require_null_gate(df: DataFrame, key: str, column: str, limit: int = MAX_NULLS_PER_SENSOR) -> DataFrame:
    verdict = null_gate(df, key, column, limit).first()
    if verdict["equal"] is False:
        raise QualityError("sensors lack different numbers of values")
    if verdict["below_limit"] is False:
        raise QualityError(f"a sensor lacks {verdict['most']} values, limit {limit}")
    return df
