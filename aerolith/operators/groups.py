"""User-supplied functions per group.

Nothing in this library uses these two: built-in features are windows and aggregates.  They
exist for a caller's own pandas code.  Each group passes through one Python worker, so the
grouping must be fine enough for its groups to fit there; split a hot key first, for
instance with ``blocks.row_blocks``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def apply_to_groups(
    df: DataFrame, keys: Sequence[str], func: Callable[[pd.DataFrame], pd.DataFrame], schema
) -> DataFrame:
    """Run ``func`` on each group and put the results together."""
    return df.groupBy(*keys).applyInPandas(func, schema)


def group_aggregate(func: Callable[[pd.Series], float]) -> Callable[..., Column]:
    """Turn a Series -> number function into an aggregate usable in ``agg``."""

    @F.pandas_udf("double")
    def aggregate(values: pd.Series) -> float:
        return func(values)

    return aggregate
