"""Concentration-to-index conversion and index bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.constants import INDEX_BANDS, INDEX_BREAKPOINTS, INDEX_DOMAIN, INDEX_TOP_BAND


def concentration_to_index(concentration: Column, strict: bool = False) -> Column:
    """Air-quality index of a concentration; NULL outside the table (an error if ``strict``)."""
    whole = F.floor(concentration).cast("double")
    value = None
    for (x0, y0), (x1, y1) in zip(INDEX_BREAKPOINTS, INDEX_BREAKPOINTS[1:]):
        line = F.floor(y0 + (whole - x0) * (y1 - y0) / (x1 - x0) + 0.5).cast("int")
        value = F.when(whole <= x1, line) if value is None else value.when(whole <= x1, line)
    inside = (whole >= 0) & (whole < INDEX_DOMAIN)
    result = F.when(inside, value)
    if strict:
        message = F.concat(F.lit("concentration outside the index table: "), concentration.cast("string"))
        result = result.when(concentration.isNotNull(), F.raise_error(message).cast("int"))
    return result


def index_band(index: Column) -> Column:
    """Named band of an index value, on half-open bounds; NULL stays NULL."""
    band = None
    for upper, label in INDEX_BANDS:
        band = F.when(index < upper, label) if band is None else band.when(index < upper, label)
    return band.when(index.isNotNull(), F.lit(INDEX_TOP_BAND))
