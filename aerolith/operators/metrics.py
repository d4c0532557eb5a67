"""Regression metrics as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    df: DataFrame, actual: str = "pm25", predicted: str = "predicted_pm25", keys: Sequence[str] = ()
) -> DataFrame:
    """Mean squared error and 1 - SSE/SST per group, over rows where both values exist.

    NULL for a group whose actual values do not vary.
    """
    pairs = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    total = F.var_pop(actual) * F.count(actual)
    return pairs.groupBy(*keys).agg(
        F.count(actual).alias("n"),
        F.avg(error * error).alias("mse"),
        F.when(total > 0, 1.0 - F.sum(error * error) / total).alias("r2"),
    )
