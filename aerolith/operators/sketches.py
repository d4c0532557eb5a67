"""Distinct counts and quantiles that merge: sketches per hour, merged to days and months.

A distinct count of a month can't be put together from its days' counts, nor a median from their
medians.  Sketches of fixed size can: they are aggregated once, in the scan that rolls up the
hours, and any longer period is merged from the stored hours without the readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: HyperLogLog with 2 ** 12 registers: a standard error of 1.04 / 64, 1.6 %; exact for a few hundred values.
LOG_REGISTERS = 12
DISTINCT_ERROR = 1.04 / 2 ** (LOG_REGISTERS / 2)
#: KLL with k = 200: ranks are within 1.65 % of the true ones with 99 % confidence.
KLL_SIZE, RANK_ERROR = 200, 0.0165


def sketch_columns(distinct: str, value: str) -> list[Column]:
    """Aggregates that keep a sketch of the different values of one column and one of the other's quantiles."""
    return [
        F.hll_sketch_agg(distinct, F.lit(LOG_REGISTERS)).alias(f"{distinct}_sketch"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_SIZE)).alias(f"{value}_sketch"),
        F.count(value).alias("n"),
    ]


def hour_sketches(df: DataFrame, distinct: str, value: str, keys: Sequence[str] = ("region",), ts: str = "timestamp") -> DataFrame:
    """A row per key and hour with the sketches of its readings."""
    return df.groupBy(*keys, F.date_trunc("hour", ts).alias("hour")).agg(*sketch_columns(distinct, value))


def merged(states: DataFrame, distinct: str, value: str, period: str, keys: Sequence[str] = ("region",), at: str = "hour") -> DataFrame:
    """The states of longer periods ("day", "month"), column ``period``, merged from those of shorter ones."""
    return states.groupBy(*keys, F.date_trunc(period, at).alias("period")).agg(
        F.hll_union_agg(f"{distinct}_sketch").alias(f"{distinct}_sketch"),
        F.kll_merge_agg_double(f"{value}_sketch").alias(f"{value}_sketch"),
        F.sum("n").alias("n"),
    )


def estimates(states: DataFrame, distinct: str, value: str, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """``states`` with the sketches replaced by distinct_<column> and <column>_q<percent>; NULL without values."""
    found = [F.hll_sketch_estimate(f"{distinct}_sketch").alias(f"distinct_{distinct}")]
    for q in quantiles:
        rank = F.kll_sketch_get_quantile_double(f"{value}_sketch", F.lit(float(q)))
        found.append(F.when(F.col("n") > 0, rank).alias(f"{value}_q{round(100 * q)}"))
    others = [c for c in states.columns if c not in (f"{distinct}_sketch", f"{value}_sketch")]
    return states.select(*others, *found)


def totals(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Counts, means and extremes for every set of ``keys`` (a data cube's levels) in one scan.

    ``level`` has a bit for each key, the first one highest, that is set where the row is a total over that key;
    it tells such rows from those of a key that is NULL.
    """
    sets = [[k for i, k in enumerate(keys) if not mask >> (len(keys) - 1 - i) & 1] for mask in range(1 << len(keys))]
    return df.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        F.grouping_id(*keys).cast("int").alias("level"), F.count(value).alias("n"), F.avg(value).alias(f"{value}_mean"),
        F.min(value).alias(f"{value}_min"), F.max(value).alias(f"{value}_max"),
    )
