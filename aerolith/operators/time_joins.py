"""Joins by time: the latest row before a moment, moments in intervals, overlapping intervals.

None of them compares all rows of a key.  As-of joins sort both sides as one series, dealt by
ranges, so that a hot key is work for several tasks.  Interval joins meet by equal time bins,
whose width grows with an interval's own length: short and long intervals alike lie in two
bins at most, three where they touch an edge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators.blocks import MOST_RUNS
from aerolith.session import materialize


def _micros(column: str, df: DataFrame) -> Column:
    """Microseconds of a timestamp of either kind, or of a date; of a wall clock without any zone's gaps."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return F.unix_micros(column)
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', CAST(`{column}` AS TIMESTAMP_NTZ))")


# --- as-of joins --------------------------------------------------------------------------


def asof_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], on: str, values: Sequence[str], right_on: str | None = None,
    tolerance: str | None = None, exact: bool = True, tie: Sequence[str] = (), matched: str | None = None,
) -> DataFrame:
    """Each row of ``left`` with ``values`` of the latest row of ``right`` of its key, at or before its time.

    ``tolerance``: an interval ("6 HOURS"); an older match is none.  ``exact=False``: only rows strictly before.
    Of several rows of ``right`` at the same time the last by ``tie`` counts (without it, the last by ``values``).
    ``matched``: a column for the match's time.  A NULL key or time matches nothing; all rows of ``left`` stay.

    Both sides are sorted as one series by ranges of (key, time) and written once; a row's match lies in its own
    range, or it is the last one of the ranges before, of which there is one row for each key and range.
    """
    right_on = right_on or on
    payload = F.struct(F.col(right_on).alias("_time"), *[F.col(v) for v in values])
    last = F.struct(*[F.col(c) for c in (tie or values)])
    complete = reduce(and_, [F.col(k).isNotNull() for k in keys], F.col(right_on).isNotNull())
    # At one moment a row of ``right`` comes before those of ``left`` that may match it, or after them.
    late = 0 if exact else 2
    known = right.filter(complete).select(
        *keys, F.col(right_on).alias("_when"), F.lit(late).alias("_side"), last.alias("_tie"), payload.alias("_match"),
        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"),
    )
    asked = left.select(
        *keys, F.col(on).alias("_when"), F.lit(1).alias("_side"), F.lit(None).cast(known.schema["_tie"].dataType).alias("_tie"),
        F.lit(None).cast(known.schema["_match"].dataType).alias("_match"), F.struct(*left.columns).alias("_row"),
    )
    sorting = [*keys, "_when", "_side", "_tie"]
    series = known.unionByName(asked).repartitionByRange(*sorting).sortWithinPartitions(*sorting)
    series = materialize(series.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    series = series.withColumn("_range", F.shiftright("_at", 33))

    runs = series.groupBy(*keys, "_range").agg(F.max_by("_match", F.when(F.col("_match").isNotNull(), F.col("_at"))).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(
        runs.select(
            *[F.col(k).alias(f"_run_{k}") for k in keys], F.col("_range").alias("_run"),
            F.last("_last", ignorenulls=True).over(earlier).alias("_carried"),
        ).filter(F.col("_carried").isNotNull())
    )
    if carried.count() <= MOST_RUNS:
        carried = F.broadcast(carried)
    so_far = Window.partitionBy(*keys, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = series.withColumn("_own", F.last("_match", ignorenulls=True).over(so_far)).filter("_side = 1")
    same = [F.col(k) == F.col(f"_run_{k}") for k in keys] + [F.col("_range") == F.col("_run")]
    found = found.join(carried, reduce(and_, same), "left").withColumn("_found", F.coalesce("_own", "_carried"))
    there = F.col("_row")[on].isNotNull() & F.col("_found").isNotNull()
    if tolerance is not None:
        there = there & (F.col("_found._time") >= F.col("_row")[on] - F.expr(f"INTERVAL {tolerance}"))
    columns = [F.col("_row")[c].alias(c) for c in left.columns]
    columns += [F.when(there, F.col("_found")[v]).alias(v) for v in values]
    if matched:
        columns.append(F.when(there, F.col("_found._time")).alias(matched))
    return found.select(*columns)


# --- interval joins -----------------------------------------------------------------------


def _level(length: Column) -> Column:
    """The power of two that isn't below a length in microseconds."""
    return F.length(F.bin(F.greatest(length, F.lit(1)))).cast("int")


def _bins(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """A row for each bin, of the interval's own width, that it lies in: two or three."""
    leveled = df.withColumns({"_first": first, "_last": last}).filter(F.col("_first") <= F.col("_last"))
    leveled = leveled.withColumn("_level", _level(F.col("_last") - F.col("_first")))
    return leveled.withColumn(
        "_bin", F.explode(F.expr("sequence(shiftright(_first, _level), shiftright(_last, _level))"))
    ).drop("_first", "_last")


def _levels(df: DataFrame) -> list[int]:
    """Widths in use; lengths are longs, so there are 64 at most."""
    return sorted(row[0] for row in df.select("_level").distinct().collect())


def interval_join(
    moments: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, start: str, end: str, how: str = "inner",
) -> DataFrame:
    """Pairs of a moment and an interval of its key with start <= ts < end; each pair once.

    ``how="left"`` keeps moments without any interval.  Columns of ``intervals`` other than the keys must not
    clash with those of ``moments``.  NULL keys and times match nothing; nor do empty or reversed intervals.
    """
    cut = _bins(intervals, _micros(start, intervals), _micros(end, intervals) - 1)
    cut = materialize(cut.withColumnsRenamed({k: f"_key_{k}" for k in keys}))
    levels = _levels(cut)
    if not levels:
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields if f.name not in keys]
        return moments.select("*", *others) if how == "left" else moments.select("*", *others).limit(0)
    asked = moments.withColumn("_moment", _micros(ts, moments))
    if how == "left":  # written, as the ids must be the same in both uses
        asked = materialize(asked.withColumn("_id", F.monotonically_increasing_id()))
    spread = asked.withColumn("_want", F.explode(F.array(*[F.lit(n) for n in levels]))).withColumn(
        "_slot", F.expr("shiftright(_moment, _want)")
    )
    same = [F.col(k) == F.col(f"_key_{k}") for k in keys] + [F.col("_want") == F.col("_level"), F.col("_slot") == F.col("_bin")]
    inside = (F.col(ts) >= F.col(start)) & (F.col(ts) < F.col(end))
    others = [c for c in intervals.columns if c not in keys]
    pairs = spread.join(cut, reduce(and_, [*same, inside]))
    if how == "inner":
        return pairs.select(*moments.columns, *others)
    matches = pairs.select(F.col("_id").alias("_found"), *others)
    return asked.join(matches, F.col("_id") == F.col("_found"), "left").select(*moments.columns, *others)


def overlap_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str]
) -> DataFrame:
    """Pairs of overlapping intervals [start, end) of the same key; each pair once, columns of both (keys of ``left``).

    Each pair is found where the later of the two begins: it begins inside the other one.
    """
    (ls, le), (rs, re) = left_span, right_span
    whole_left, whole_right = left.filter(F.col(le) > F.col(ls)), right.filter(F.col(re) > F.col(rs))

    def held(df: DataFrame, start: str, end: str) -> DataFrame:
        """The intervals to be met, with their rows as one column."""
        return df.select(*keys, F.struct(*df.columns).alias("_other"), F.col(start).alias("_from"), F.col(end).alias("_to"))

    others = [c for c in right.columns if c not in keys]
    later_right = interval_join(whole_right, held(whole_left, ls, le), keys, rs, "_from", "_to")
    later_left = interval_join(whole_left, held(whole_right, rs, re), keys, ls, "_from", "_to").filter(F.col(ls) > F.col("_from"))
    first = later_right.select(*[F.col("_other")[c].alias(c) for c in left.columns], *others)
    return first.unionByName(later_left.select(*left.columns, *[F.col("_other")[c].alias(c) for c in others]))
