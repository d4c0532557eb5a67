"""Small text helpers for names and dirty numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.constants import UNKNOWN_STATION


def to_number(text: Column) -> Column:
    """Text or number -> double; anything unreadable (and NaN) -> NULL."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_name(name: Column) -> Column:
    """A station name that can be part of a file name."""
    return F.translate(name, " /\\", "___")


def station_name_or_default(name: Column) -> Column:
    return F.coalesce(name, F.lit(UNKNOWN_STATION))


def last_part(path: Column, separator: str = "/") -> Column:
    return F.element_at(F.split(path, separator), -1)


def street_name(name: Column) -> Column:
    """First letter upper, rest lower (one word or many)."""
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))


def mentions_missing_data(message: Column) -> Column:
    """An error text that says there is no data for the day, in any letter case."""
    return F.lower(message).contains("not found")
