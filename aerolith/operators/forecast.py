"""Recursive multi-day forecast.

Each region is one row: its last 28 values as an array, the coming days' weather as an
array of at most 7.  A forecast step appends a value to the array.  A step is therefore a
row-local projection over all regions, without a join or shuffle, and with one model the
whole week is a single chain of them whose plan grows linearly with the number of days.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.constants import DAILY_LAGS, DAILY_WINDOWS
from aerolith.functions.times import calendar_columns
from aerolith.operators.joins import first_rows, last_rows
from aerolith.session import materialize

Scorer = Callable[[DataFrame], DataFrame]
KEEP = max(*DAILY_LAGS, *DAILY_WINDOWS)
_INTERNAL = ("_values", "_weather", "_steps")


def forecast_state(
    history: DataFrame, weather: DataFrame, as_of, days: int = 7, value: str = "pm25", keys: Sequence[str] = ("region",)
) -> DataFrame:
    """One row per key: recent values before ``as_of`` and the weather from ``as_of`` on."""
    past = history.filter((F.col("timestamp") < F.lit(as_of)) & F.col(value).isNotNull())
    recent = last_rows(past.select(*keys, "timestamp", value), KEEP, keys)
    point = F.struct(F.unix_date(F.to_date("timestamp")).alias("day"), F.col(value).cast("double").alias("value"))
    values = recent.groupBy(*keys).agg(F.sort_array(F.collect_list(point)).alias("_values"))

    ahead = first_rows(weather.filter(F.col("timestamp") >= F.lit(as_of)), days, keys)
    columns = [c for c in ahead.columns if c not in keys]
    row = F.struct("timestamp", *[c for c in columns if c != "timestamp"])
    coming = ahead.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("_weather"))
    return coming.join(values, list(keys), "left").withColumn(
        "_values", F.coalesce("_values", F.array().cast("array<struct<day:int,value:double>>"))
    )


def _lag(values: Column, day: Column, n: int) -> Column:
    """The value exactly n days before; the last one if a day has several."""
    return F.try_element_at(F.filter(values, lambda v: v["day"] == day - n), F.lit(-1))["value"]


def _window(values: Column, day: Column, n: int, shortened: bool) -> Column:
    if shortened:
        picked = F.filter(values, lambda v: (v["day"] > day - n) & (v["day"] <= day - 1))
    else:
        earlier = F.filter(values, lambda v: v["day"] < day)
        picked = F.slice(earlier, F.greatest(F.size(earlier) - n + 1, F.lit(1)), F.lit(n))
    return F.transform(picked, lambda v: v["value"])


def _statistics(window: Column, needed: int) -> dict[str, Column]:
    n = F.size(window)
    zero = F.lit(0.0)
    mean = F.aggregate(window, zero, lambda a, x: a + x) / n
    squares = F.aggregate(window, zero, lambda a, x: a + (x - mean) * (x - mean))
    enough = n >= needed
    return {
        "mean": F.when(enough, mean),
        "min": F.when(enough, F.array_min(window)),
        "max": F.when(enough, F.array_max(window)),
        "std": F.when(enough & (n > 1), F.sqrt(squares / (n - 1))),
    }


def _step(state: DataFrame, k: int, scorer: Scorer, keys: Sequence[str], shortened: bool, value: str) -> DataFrame:
    weather = F.get("_weather", F.lit(k - 1))
    own = {f"{value}_lag_{n}d" for n in DAILY_LAGS} | {"day_of_week", "day_of_month", "month", "year", "is_weekend"}
    own |= {f"{value}_rolling_{s}_{n}d" for n in DAILY_WINDOWS for s in ("mean", "min", "max", "std")}
    fields = [f for f in state.schema["_weather"].dataType.elementType.names if f not in own and f not in keys]
    now = state.select(*keys, *_INTERNAL, *[weather[f].alias(f) for f in fields])
    now = now.withColumn("_day", F.unix_date(F.to_date("timestamp")))

    values, day = F.col("_values"), F.col("_day")
    now = now.select("*", *[_window(values, day, n, shortened).alias(f"_w{n}") for n in DAILY_WINDOWS])
    derived = [_lag(values, day, n).alias(f"{value}_lag_{n}d") for n in DAILY_LAGS]
    for n in DAILY_WINDOWS:
        needed = 1 if shortened else max(1, n // 2)
        derived += [c.alias(f"{value}_rolling_{s}_{n}d") for s, c in _statistics(F.col(f"_w{n}"), needed).items()]
    calendar = calendar_columns(F.col("timestamp"), with_hour=False)
    scored = scorer(now.select("*", *derived, *calendar).drop(*[f"_w{n}" for n in DAILY_WINDOWS]))

    predicted = F.when(F.col("timestamp").isNotNull(), F.col("predicted_pm25"))
    done = F.struct(
        F.col("timestamp"), F.lit(k).alias("days_before_forecast_day"), predicted.alias("predicted_pm25")
    )
    point = F.struct(F.col("_day").alias("day"), predicted.alias("value"))
    return scored.select(
        *keys,
        F.when(predicted.isNotNull(), F.concat(values, F.array(point))).otherwise(values).alias("_values"),
        "_weather",
        F.concat(F.col("_steps"), F.array(done)).alias("_steps"),
    )


def _empty_steps(state: DataFrame) -> Column:
    kind = state.schema["_weather"].dataType.elementType["timestamp"].dataType.simpleString()
    return F.array().cast(f"array<struct<timestamp:{kind},days_before_forecast_day:int,predicted_pm25:double>>")


def recursive_forecast(
    state: DataFrame, scorer: Scorer, days: int = 7, keys: Sequence[str] = ("region",), shortened: bool = False,
    value: str = "pm25",
) -> DataFrame:
    """Forecast up to ``days`` days ahead, feeding each prediction to the following steps.

    ``shortened=False`` computes rolling windows as in training: the last w values.
    ``shortened=True`` takes the values after ts - w days, which is one day less.
    """
    current = state.withColumn("_steps", _empty_steps(state))
    for k in range(1, days + 1):
        current = _step(current, k, scorer, keys, shortened, value)
    # The outer form: for plain inline the optimizer would infer a filter on the array and
    # push it down by substituting all steps into one another.
    rows = current.select(*keys, F.inline_outer("_steps"))
    return rows.filter(F.col("timestamp").isNotNull())


def by_region(scorers: Mapping[str, Scorer], key: str = "region") -> Scorer:
    """One scorer that applies each region's own to its rows."""

    def score(df: DataFrame) -> DataFrame:
        out = None
        for region, scorer in scorers.items():
            part = scorer(df.filter(F.col(key) == region))
            out = part if out is None else out.unionByName(part)
        return out

    return score


def forecast_regions(
    state: DataFrame, scorers: Scorer | Mapping[str, Scorer], days: int = 7, shortened: bool = False, value: str = "pm25"
) -> DataFrame:
    """Forecasts of all regions, each by its own model: one scorer that knows them all, or one for each region.

    Every step scores all regions in one job and stores the state, one row per region:
    planning a week for each of several models in one piece takes longer than running it.
    """
    each = isinstance(scorers, Mapping)
    scorer = by_region(scorers) if each else scorers
    current = materialize(state.withColumn("_steps", _empty_steps(state)))
    for k in range(1, days + 1):
        stepped = _step(current, k, scorer, ["region"], shortened, value)
        # Gather again: a union of filtered copies has as many partitions as all copies together.
        current = materialize(stepped.repartition("region") if each else stepped)
    return current.select("region", F.inline("_steps")).filter(F.col("timestamp").isNotNull())


def linear_scorer(weights: Mapping[str, float], intercept: float = 0.0) -> Scorer:
    """A fixed linear model over feature columns; a missing feature contributes nothing."""

    def score(df: DataFrame) -> DataFrame:
        total = F.lit(float(intercept))
        for feature, weight in weights.items():
            total = total + F.coalesce(F.col(feature).cast("double"), F.lit(0.0)) * float(weight)
        return df.withColumn("predicted_pm25", total)

    return score
