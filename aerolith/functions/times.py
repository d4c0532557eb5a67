"""Time helpers.  ``tz`` names the zone whose clock defines hours and days.

With ``tz=None`` a column is taken as wall-clock time already.  With a zone, the column is
an instant (``timestamp``), or a zone-less clock reading of ``source_tz`` (``timestamp_ntz``).
Run sessions in UTC: zones with daylight saving skip and repeat hours.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(text: Column) -> Column:
    """ISO text with offset -> instant; text that is no timestamp -> NULL."""
    return F.try_to_timestamp(text)


def parse_day(text: Column) -> Column:
    """Date written with dashes or slashes, leading zeros or not; anything else -> NULL."""
    return F.coalesce(F.try_to_timestamp(text), F.try_to_timestamp(text, F.lit("y/M/d"))).cast("date")


def local_clock(ts: Column, tz: str | None, source_tz: str | None = None) -> Column:
    """Wall-clock reading in ``tz`` (no zone attached).

    ``source_tz`` is needed for zone-less input only.
    """
    if tz is None:
        return ts.cast("timestamp_ntz")
    if source_tz is not None:
        return F.convert_timezone(F.lit(source_tz), F.lit(tz), ts.cast("timestamp_ntz"))
    return F.convert_timezone(None, F.lit(tz), ts)


def hour_start(ts: Column, tz: str | None = None, source_tz: str | None = None) -> Column:
    """Start of the wall-clock hour."""
    clock = local_clock(ts, tz, source_tz)
    return F.to_date(clock).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(clock))


def local_day(ts: Column, tz: str | None = None, source_tz: str | None = None) -> Column:
    return F.to_date(local_clock(ts, tz, source_tz))


def day_timestamp(day: Column) -> Column:
    """Midnight of a day, the key form of daily tables."""
    return day.cast("timestamp_ntz")


def to_instant(clock: Column, tz: str) -> Column:
    """Inverse of ``local_clock``: wall-clock reading in ``tz`` -> UTC clock reading."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), clock.cast("timestamp_ntz"))


def from_unix_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def minus_days(ts: Column, days: int) -> Column:
    return ts - F.expr(f"INTERVAL {int(days)} DAYS")


def plus_days(ts: Column, days: int) -> Column:
    return ts + F.expr(f"INTERVAL {int(days)} DAYS")


def day_sequence(first: Column, last: Column) -> Column:
    """All days from first to last, both included."""
    return F.sequence(first, last, F.expr("INTERVAL 1 DAY"))


def regular_times(start: Column, end: Column, step_seconds: Column) -> Column:
    """start, start+step, ... strictly before end, in unix seconds; empty if end <= start."""
    last = end - step_seconds
    return F.when(last >= start, F.sequence(start, last, step_seconds)).otherwise(F.array().cast("array<bigint>"))


def format_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def calendar_columns(ts: Column, with_hour: bool) -> list[Column]:
    """hour (optional), day_of_week (Monday = 0), day_of_month, month, year, is_weekend."""
    weekday = F.weekday(ts)
    columns = [F.hour(ts).cast("tinyint").alias("hour")] if with_hour else []
    return columns + [
        weekday.cast("tinyint").alias("day_of_week"),
        F.dayofmonth(ts).cast("tinyint").alias("day_of_month"),
        F.month(ts).cast("tinyint").alias("month"),
        F.year(ts).alias("year"),
        (weekday >= 5).alias("is_weekend"),
    ]
