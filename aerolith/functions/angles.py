"""Circular statistics over degrees, as plain aggregate expressions.

Sine and cosine sums combine partially on the map side like any other average, so a hot
group costs one small buffer per task, and no user-defined aggregate is involved.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _present(angle: Column) -> Column:
    # NaN means missing in sensor data; averages only skip NULL.
    return F.nanvl(angle.cast("double"), F.lit(None).cast("double"))


def _mean_from_components(mean_sin: Column, mean_cos: Column) -> Column:
    degrees = F.degrees(F.atan2(mean_sin, mean_cos))
    return F.when(degrees < 0, degrees + 360.0).otherwise(degrees)


def _length_from_components(mean_sin: Column, mean_cos: Column) -> Column:
    # Rounding can push the length above 1, where the logarithm would turn positive.
    # (Not least(): it skips NULL, and an empty group would seem to agree perfectly.)
    length = F.sqrt(mean_sin * mean_sin + mean_cos * mean_cos)
    return F.when(length > 1, 1.0).otherwise(length)


def _std_from_length(length: Column) -> Column:
    # ln(0) is NULL in Spark but the spread is unbounded there; abs() turns -0.0 into 0.0.
    return F.when(length == 0, F.lit(float("inf"))).otherwise(F.abs(F.sqrt(-2.0 * F.ln(length))))


def circular_mean(angle: Column) -> Column:
    """Mean direction in [0, 360]; missing values ignored, NULL for an empty group."""
    rad = F.radians(_present(angle))
    return _mean_from_components(F.avg(F.sin(rad)), F.avg(F.cos(rad)))


def resultant_length(angle: Column) -> Column:
    """1 when all angles agree, 0 when they cancel out (the mean is arbitrary there)."""
    rad = F.radians(_present(angle))
    return _length_from_components(F.avg(F.sin(rad)), F.avg(F.cos(rad)))


def circular_std(angle: Column) -> Column:
    """sqrt(-2 ln R): 0 when all angles agree, without upper bound."""
    return _std_from_length(resultant_length(angle))


def sine_sum(angle: Column) -> Column:
    return F.sum(F.sin(F.radians(_present(angle))))


def cosine_sum(angle: Column) -> Column:
    return F.sum(F.cos(F.radians(_present(angle))))


def circular_mean_of_sums(sin_sum: Column, cos_sum: Column) -> Column:
    """Mean direction from already summed components (any common divisor cancels)."""
    return _mean_from_components(sin_sum, cos_sum)


def circular_std_of_sums(sin_sum: Column, cos_sum: Column, n: Column) -> Column:
    return _std_from_length(_length_from_components(sin_sum / n, cos_sum / n))


def wind_u(direction: Column) -> Column:
    """Eastward component of a wind that blows *from* ``direction``."""
    return -F.sin(F.radians(direction))


def wind_v(direction: Column) -> Column:
    return -F.cos(F.radians(direction))
