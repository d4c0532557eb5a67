"""Projections, predicates and cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.constants import VALID_DIRECTION
from aerolith.functions.text import to_number


def coerce_numeric(df: DataFrame, column: str, required: bool = True) -> DataFrame:
    """Turn a text column into numbers; with ``required``, rows without a number go."""
    out = df.withColumn(column, to_number(F.col(column)))
    return out.dropna(subset=[column]) if required else out


def within(column: str, bounds: tuple[float, float]) -> Column:
    return F.col(column).between(*bounds)


def valid_directions(df: DataFrame, column: str) -> DataFrame:
    """Keep angles in 0..360, both bounds included."""
    return df.filter(within(column, VALID_DIRECTION))


def validity_report(df: DataFrame, column: str, bounds: tuple[float, float] = VALID_DIRECTION) -> DataFrame:
    """Row counts before and after cleaning one column, in a single pass."""
    number = to_number(F.col(column))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(number.isNull()).alias("not_numeric"),
        F.count_if(~number.between(*bounds)).alias("out_of_range"),
        F.count_if(number.between(*bounds)).alias("kept"),
    )


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns all at once, so that two names may swap."""
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Columns in the wanted order, leaving out those the table does not have."""
    present = set(df.columns)
    return df.select(*[c for c in wanted if c in present])


def drop_existing(df: DataFrame, unwanted: Iterable[str]) -> DataFrame:
    return df.drop(*unwanted)


def complete_cases(df: DataFrame, optional: Iterable[str] = ()) -> DataFrame:
    """Rows without a missing value in any column but the optional ones.

    One predicate per column.  ``dropna`` would put all columns into one expression, for
    which the optimizer derives constraints in every combination of aliases: with 40 derived
    columns, planning a join on top of it takes longer than running it.
    """
    skipped = set(optional)
    condition = None
    for field in df.schema.fields:
        if field.name in skipped:
            continue
        present = F.col(f"`{field.name}`").isNotNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            present = present & ~F.isnan(F.col(f"`{field.name}`"))
        condition = present if condition is None else condition & present
    return df if condition is None else df.filter(condition)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skipped = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skipped]


def align_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The features a model wants, in its order, as doubles; absent ones are missing values."""
    present = set(df.columns)
    return df.select(
        *keep,
        *[(F.col(c) if c in present else F.lit(None)).cast("double").alias(c) for c in features],
    )


def since(df: DataFrame, column: str, threshold) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(threshold))


def before(df: DataFrame, column: str, as_of) -> DataFrame:
    return df.filter(F.col(column) < F.lit(as_of))


def in_region(df: DataFrame, region: str | None) -> DataFrame:
    return df if region is None else df.filter(F.col("region") == region)


def describe_columns(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach descriptions, which Parquet tables keep with the schema."""
    out = df
    for column, comment in comments.items():
        if column in df.columns:
            out = out.withMetadata(column, {**df.schema[column].metadata, "comment": comment})
    return out


def column_descriptions(df: DataFrame) -> DataFrame:
    """column, type, comment of a table as it was stored; columns without a description have NULL."""
    rows = [(f.name, f.dataType.simpleString(), f.metadata.get("comment")) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, comment string")


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows by ``order``, for looking at a table."""
    return df.orderBy(*order).limit(n)


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type, count of values and of missing values for each column, in one pass."""
    counts = df.agg(
        *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)],
        F.count(F.lit(1)).alias("total"),
    )
    rows = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("present"),
            (F.col("total") - F.col(f"n{i}")).alias("missing"),
        )
        for i, field in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))
