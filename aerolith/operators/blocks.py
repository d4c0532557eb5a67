"""Cutting long series into blocks, so that one hot key does not become one task.

A window over ``(key)`` puts a whole series into one task.  Cutting the series into blocks
and copying the few rows at the edges that a neighbour looks back (or ahead) at gives the
same results from windows over ``(key, block)``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.session import materialize

BLOCK = "_block"
OWN = "_own"
#: A table of so many rows (key and range of rows each) is broadcast; beyond, Spark joins by shuffle.
MOST_RUNS = 1_000_000


def with_row_number(df: DataFrame, keys: Sequence[str], order: str, tie: Sequence[str] = ()) -> DataFrame:
    """Add ``_row``: 0-based position in the key's series, without a key being sorted in one task.

    The rows are dealt by ranges of (key, order) once, sorted there and written with their number
    inside the range; a hot key simply fills several ranges.  The rows of a key in each range,
    one number a range and key, then tell where the range's rows begin in the key's series.
    """
    sorting = [*keys, order, *tie]
    ranged = df.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
    # Number of the range above bit 33, number of the row inside it below: rows of a key are consecutive.
    rows = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()))
    runs = rows.groupBy(*keys, F.shiftright("_at", 33).alias("_range")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = materialize(
        runs.select(
            *[F.col(k).alias(f"_run_{k}") for k in keys], "_range",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        )
    )
    if runs.count() <= MOST_RUNS:
        runs = F.broadcast(runs)
    same = [F.col(k).eqNullSafe(F.col(f"_run_{k}")) for k in keys] + [F.shiftright("_at", 33) == F.col("_range")]
    joined = rows.join(runs, reduce(and_, same))
    return joined.withColumn("_row", F.col("_at") + F.col("_shift")).select(*df.columns, "_row")


def _copies(df: DataFrame, position: Column, size: int, back: int, ahead: int) -> DataFrame:
    """One copy of each row per block that needs it.

    A row at position p serves blocks whose rows look back at it (up to ``back`` later) or
    look ahead at it (up to ``ahead`` earlier).
    """
    own = F.floor(position / size).cast("bigint")
    first = F.floor((position - ahead) / size).cast("bigint")
    last = F.floor((position + back) / size).cast("bigint")
    return df.withColumn("_home", own).withColumn(BLOCK, F.explode(F.sequence(first, last))).withColumn(
        OWN, F.col(BLOCK) == F.col("_home")
    ).drop("_home")


def row_blocks(
    df: DataFrame, keys: Sequence[str], order: str, back: int, ahead: int = 0,
    block_rows: int = 100_000, tie: Sequence[str] = (),
) -> DataFrame:
    """Blocks for frames that count rows: ``back`` rows before and ``ahead`` rows after."""
    numbered = with_row_number(df, keys, order, tie)
    return _copies(numbered, F.col("_row"), block_rows, back, ahead).drop("_row")


def day_blocks(df: DataFrame, day_number: str, back_days: int, ahead_days: int = 0, block_days: int = 512) -> DataFrame:
    """Blocks for frames that measure days; they need no counting at all."""
    return _copies(df, F.col(day_number), block_days, back_days, ahead_days)


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the borrowed edge rows again."""
    return df.filter(OWN).drop(OWN, BLOCK)
