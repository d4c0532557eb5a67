"""Calendar, lag, rolling-window and multi-horizon features.

One generic operator serves all series; what differs between them is data (``SeriesSpec``).
All lags and rolling statistics share one partitioning and ordering, so however many
columns are derived, Spark plans a single exchange and a single sort for them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith import constants as C
from aerolith.functions.angles import wind_u, wind_v
from aerolith.functions.times import calendar_columns, day_sequence, local_clock
from aerolith.operators.blocks import BLOCK, day_blocks, own_rows, row_blocks
from aerolith.operators.clean import complete_cases

# A series known to stay below this many rows per key is left in one window partition:
# a few seconds of work for a task.  Everything else is cut into blocks.
PLAIN_WINDOW_ROWS = 2_000_000

# Series tables hold one row per key and hour (or day), which bounds them by the calendar
# whatever the number of readings behind them: a century of hours, of days.
HOURLY_SERIES_ROWS = 876_600
DAILY_SERIES_ROWS = 36_525

# 168 rows as frames took half the time of layers (100,000 readings, 26 features).
LONG_WINDOW = 1_000

_STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
ALL_STATS = ("mean", "std", "min", "max")


@dataclass(frozen=True)
class SeriesSpec:
    """What to derive from a series.

    ``lagged``: (name, source column); ``rolled``: (name, source column, statistics).
    ``min_periods``: values a window needs: "half" of it (at least one), "full", or a number.
    ``layered``: put windows together from windows of 1, 8, 64, ... rows.  A frame of w rows costs
    w steps per row in Spark, this costs some steps for each digit of w, but more for each step:
    by default it is taken from windows of ``LONG_WINDOW`` rows on.
    """

    unit: str
    lagged: tuple[tuple[str, str], ...]
    lags: tuple[int, ...]
    rolled: tuple[tuple[str, str, tuple[str, ...]], ...]
    windows: tuple[int, ...]
    min_periods: str | int = "half"
    rows_per_key: int | None = None
    layered: bool | None = None
    components_of: str | None = None  # direction column to split into wind_u / wind_v
    horizons: tuple[int, ...] = ()  # rows ahead, for targets
    target: str | None = None
    lag_pattern: str = "{name}_lag_{n}{unit}"
    roll_pattern: str = "{name}_rolling_{stat}_{n}{unit}"

    @property
    def back(self) -> int:
        return max((*self.lags, *self.windows), default=0)

    @property
    def ahead(self) -> int:
        return max(self.horizons, default=0)


def _scalar_spec(name: str, column: str, unit: str, lags, windows) -> SeriesSpec:
    bound = DAILY_SERIES_ROWS if unit == "d" else HOURLY_SERIES_ROWS
    return SeriesSpec(
        unit, ((name, column),), lags, ((name, column, ALL_STATS),), windows, rows_per_key=bound
    )


def _direction_spec(direction: str, spread: str, unit: str, lags, windows) -> SeriesSpec:
    bound = DAILY_SERIES_ROWS if unit == "d" else HOURLY_SERIES_ROWS
    return SeriesSpec(
        unit,
        (("wind_u", "wind_u"), ("wind_v", "wind_v"), ("wind_direction", direction)),
        lags,
        (("wind_u", "wind_u", ("mean",)), ("wind_v", "wind_v", ("mean",)), ("direction_std", spread, ("mean",))),
        windows,
        rows_per_key=bound,
        components_of=direction,
    )


SERIES = {
    "pm25_daily": _scalar_spec("pm25", "pm25", "d", C.DAILY_LAGS, C.DAILY_WINDOWS),
    "pm25_hourly": _scalar_spec("pm25", "pm25", "h", C.PM25_HOURLY_LAGS, C.HOURLY_WINDOWS),
    "wind_direction_hourly": _direction_spec(
        "wind_direction_avg", "wind_direction_std", "h", C.WEATHER_HOURLY_LAGS, C.HOURLY_WINDOWS
    ),
    "wind_speed_hourly": _scalar_spec("wind_speed", "wind_speed_avg", "h", C.WEATHER_HOURLY_LAGS, C.HOURLY_WINDOWS),
    "air_temperature_hourly": _scalar_spec(
        "air_temperature", "air_temperature_avg", "h", C.WEATHER_HOURLY_LAGS, C.HOURLY_WINDOWS
    ),
    "wind_direction_daily": _direction_spec(
        "wind_direction_avg_mean", "wind_direction_avg_std", "d", C.DAILY_LAGS, C.DAILY_WINDOWS
    ),
    "wind_speed_daily": _scalar_spec("wind_speed", "wind_speed_avg_mean", "d", C.DAILY_LAGS, C.DAILY_WINDOWS),
    "air_temperature_daily": _scalar_spec(
        "air_temperature", "air_temperature_avg_mean", "d", C.DAILY_LAGS, C.DAILY_WINDOWS
    ),
}

TARGETS = SeriesSpec(
    "h", (("pm25", "pm25"),), C.TARGET_LAGS, (("pm25", "pm25", ("mean", "std")),), C.TARGET_WINDOWS,
    min_periods="full", rows_per_key=HOURLY_SERIES_ROWS, horizons=C.TARGET_HORIZONS, target="pm25",
)

SENSOR_DAYS = SeriesSpec(
    "d", (("pm", "pm25"),), C.SENSOR_LAGS, (("pm", "pm25", ("mean", "std")),), C.SENSOR_WINDOWS,
    min_periods=1, rows_per_key=DAILY_SERIES_ROWS, lag_pattern="{name}_lag_{n}", roll_pattern="{name}_roll_{stat}_{n}",
)

CITY_DAYS = SeriesSpec(
    "d", (), (),
    (("temp", "temperature_2m_mean", ("mean",)), ("wind_speed", "wind_speed_10m_max", ("mean",))),
    C.SENSOR_WINDOWS, min_periods=1, rows_per_key=DAILY_SERIES_ROWS, roll_pattern="{name}_roll_{stat}_{n}",
)


def _needed(spec: SeriesSpec, window: int) -> int:
    if spec.min_periods == "half":
        return max(1, window // 2)
    return window if spec.min_periods == "full" else int(spec.min_periods)


def _rolling(df: DataFrame, spec: SeriesSpec, ordered) -> DataFrame:
    """Add lags, rolling statistics and targets; the windows end at the row before the current one."""
    columns = []
    for n in spec.lags:
        for name, source in spec.lagged:
            columns.append(F.lag(source, n).over(ordered).alias(spec.lag_pattern.format(name=name, n=n, unit=spec.unit)))
    for n in spec.horizons:
        columns.append(F.lead(spec.target, n).over(ordered).alias(f"target_{n // 24}d"))
    long = max(spec.windows, default=0) >= LONG_WINDOW
    if long if spec.layered is None else spec.layered:
        return _layered(df, spec, ordered, columns)
    for n in spec.windows:
        # The n rows before the current one; the current value never leaks into a feature.
        frame, needed = ordered.rowsBetween(-n, -1), _needed(spec, n)
        for name, source, stats in spec.rolled:
            enough = F.count(source).over(frame) >= needed
            for stat in stats:
                alias = spec.roll_pattern.format(name=name, stat=stat, n=n, unit=spec.unit)
                columns.append(F.when(enough, _STATS[stat](source).over(frame)).alias(alias))
    return df.select("*", *columns)


# --- windows of windows -------------------------------------------------------------------
#
# The state of a window: how many values it has, their sum, the sum of their squared distances
# from their mean, and their extremes.  Eight neighbouring windows of 8^k rows make one of 8^(k+1),
# from seven lags.  A window of w rows is then put together from as many states as the digits of w
# to base 8 add up to.  Nothing is subtracted, so nothing cancels out, however long the series.

RADIX = 8


def _table(source: str, level: int) -> str:
    return f"_rolled_{source}_{level}"


def _levels(window: int) -> int:
    """The highest power of the radix that the window holds."""
    level = 0
    while RADIX ** (level + 1) <= window:
        level += 1
    return level


def _pieces(window: int) -> list[tuple[int, int]]:
    """(level, offset) of states that make up a window without overlap, the latest rows first."""
    out, offset = [], 1
    for level in reversed(range(_levels(window) + 1)):
        size = RADIX**level
        while window - (offset - 1) >= size:
            out.append((level, offset))
            offset += size
    return out


def _totals(states: Sequence[Column]) -> tuple[Column, Column]:
    """(count, sum) of neighbouring windows; those before the first row are NULL."""
    none, zero = F.lit(0).cast("bigint"), F.lit(0.0)
    return reduce(add, [F.coalesce(s["n"], none) for s in states]), reduce(add, [F.coalesce(s["sum"], zero) for s in states])


def _squares(states: Sequence[Column], total: Column, whole: Column) -> Column:
    """Squared distances from the common mean: those inside each window, and those of the windows' means."""
    mean = whole / total
    parts = [F.when(s["n"] > 0, s["sq"] + s["n"] * F.pow(s["sum"] / s["n"] - mean, F.lit(2.0))).otherwise(0.0) for s in states]
    return reduce(add, [F.coalesce(p, F.lit(0.0)) for p in parts])


def _extreme(states: Sequence[Column], name: str) -> Column:
    ends = [s[name] for s in states]
    return (F.least if name == "min" else F.greatest)(*ends) if len(ends) > 1 else ends[0]


def _layered(df: DataFrame, spec: SeriesSpec, ordered, others: list[Column]) -> DataFrame:
    """``others`` and the rolling statistics; the tables of states are built on the input's columns alone."""
    fields: dict[str, list[str]] = {}
    for _, source, stats in spec.rolled:
        known = set(fields.get(source, ())) | {"sq" if s == "std" else s for s in stats if s != "mean"}
        fields[source] = [f for f in ("sq", "min", "max") if f in known]
    out = df
    for source, extra in fields.items():
        value = F.col(source)
        single = [value.isNotNull().cast("bigint").alias("n"), F.coalesce(value.cast("double"), F.lit(0.0)).alias("sum")]
        single += [(F.lit(0.0) if f == "sq" else value).alias(f) for f in extra]
        out = out.withColumn(_table(source, 0), F.struct(*single))
    for level in range(_levels(max(spec.windows, default=1))):
        early = {s: [f"_early_{s}_{j}" for j in range(1, RADIX)] for s in fields}
        shifted = [
            F.lag(_table(s, level), j * RADIX**level).over(ordered).alias(name) for s in fields for j, name in enumerate(early[s], 1)
        ]
        out = out.select("*", *shifted)
        states = {s: [F.col(_table(s, level)), *map(F.col, early[s])] for s in fields}
        sums = {s: _totals(states[s]) for s in fields}
        out = out.select("*", *[c.alias(f"_{kind}_{s}") for s in fields for kind, c in zip(("n", "sum"), sums[s])])
        merged = {}
        for s, extra in fields.items():
            n, total = F.col(f"_n_{s}"), F.col(f"_sum_{s}")
            parts = [n.alias("n"), total.alias("sum")]
            for f in extra:
                value = F.when(n > 0, _squares(states[s], n, total)).otherwise(0.0) if f == "sq" else _extreme(states[s], f)
                parts.append(value.alias(f))
            merged[_table(s, level + 1)] = F.struct(*parts)
        out = out.withColumns(merged).drop(*[c for s in fields for c in (*early[s], f"_n_{s}", f"_sum_{s}")])

    wanted = {(s, *piece) for n in spec.windows for _, s, _ in spec.rolled for piece in _pieces(n)}
    lagged = {key: f"_piece_{key[0]}_{key[1]}_{key[2]}" for key in sorted(wanted)}
    shifted = [F.lag(_table(s, level), offset).over(ordered).alias(alias) for (s, level, offset), alias in lagged.items()]
    out = out.select(*df.columns, *others, *shifted)
    pieces = {(s, n): [F.col(lagged[s, *p]) for p in _pieces(n)] for n in spec.windows for s in fields}
    sums = {key: _totals(states) for key, states in pieces.items()}
    out = out.select("*", *[c.alias(f"_{kind}_{s}_{n}") for (s, n), both in sums.items() for kind, c in zip(("n", "sum"), both)])
    results: dict[str, Column] = {}
    for n in spec.windows:
        for name, source, stats in spec.rolled:
            states, total, whole = pieces[source, n], F.col(f"_n_{source}_{n}"), F.col(f"_sum_{source}_{n}")
            for stat in stats:
                if stat == "mean":
                    value = whole / total
                elif stat == "std":
                    value = F.when(total > 1, F.sqrt(_squares(states, total, whole) / (total - 1)))
                else:
                    value = _extreme(states, stat)
                alias = spec.roll_pattern.format(name=name, stat=stat, n=n, unit=spec.unit)
                results[alias] = F.when(total >= max(1, _needed(spec, n)), value)
    return out.select(*df.columns, *[results[c].alias(c) if c in results else F.col(c) for c in _feature_names(spec)])


def _feature_names(spec: SeriesSpec) -> list[str]:
    names = [spec.lag_pattern.format(name=name, n=n, unit=spec.unit) for n in spec.lags for name, _ in spec.lagged]
    for n in spec.windows:
        for name, _, stats in spec.rolled:
            names += [spec.roll_pattern.format(name=name, stat=s, n=n, unit=spec.unit) for s in stats]
    return names + [f"target_{n // 24}d" for n in spec.horizons]


def series_features(
    df: DataFrame, spec: SeriesSpec, keys: Sequence[str] = ("region",), order: str = "timestamp",
    complete: bool = True, block_rows: int | None = None, tie: Sequence[str] = (),
    optional: Sequence[str] = (),
) -> DataFrame:
    """Add the spec's features per key; with ``complete``, keep complete rows only.

    ``optional`` columns may be missing in a complete row.

    The window runs over whole keys only when the spec proves them short.  Otherwise, or
    when ``block_rows`` is given, over blocks of rows with borrowed edges - same result.
    """
    out = df
    if spec.components_of:
        out = out.withColumns({"wind_u": wind_u(F.col(spec.components_of)), "wind_v": wind_v(F.col(spec.components_of))})
    plain = block_rows is None and spec.rows_per_key is not None and spec.rows_per_key <= PLAIN_WINDOW_ROWS
    if plain:
        ordered = Window.partitionBy(*keys).orderBy(order, *tie)
        out = _rolling(out, spec, ordered)
    else:
        cut = row_blocks(out, keys, order, spec.back, spec.ahead, block_rows or 100_000, tie)
        ordered = Window.partitionBy(*keys, BLOCK).orderBy(order, *tie)
        out = own_rows(_rolling(cut, spec, ordered))
    return complete_cases(out, optional) if complete else out


def add_calendar(
    df: DataFrame, with_hour: bool, order: str = "timestamp", tz: str | None = None, source_tz: str | None = None
) -> DataFrame:
    """Calendar columns of the wall clock in ``tz`` (of the column itself without one)."""
    return df.select("*", *calendar_columns(local_clock(F.col(order), tz, source_tz), with_hour))


def table_features(df: DataFrame, table: str, keys: Sequence[str] = ("region",), **options) -> DataFrame:
    """Features of one of the eight series tables, by table name."""
    # The index beside an hourly concentration is NULL where the index table ends.
    options.setdefault("optional", ("pm25_aqi",))
    return series_features(df, SERIES[table], keys, **options)


def seasonal_features(df: DataFrame, table: str, hour: str = "hour", **options) -> DataFrame:
    """Features per (region, hour of day): lag 1 is the same hour one day earlier."""
    return table_features(df, table, ("region", hour), **options)


def multi_horizon_targets(df: DataFrame, keys: Sequence[str] = ("region",), horizons=C.TARGET_HORIZONS, **options):
    """Calendar, lags, full-window statistics, and the values 1 to 7 days ahead as targets."""
    spec = replace(TARGETS, horizons=tuple(horizons))
    calendar = add_calendar(df, with_hour=True)
    numbers = calendar.withColumns(
        {c: F.col(c).cast("int") for c in ("hour", "day_of_week", "day_of_month", "month", "year", "is_weekend")}
    )
    return series_features(numbers, spec, keys, **options)


def sensor_features(df: DataFrame, keys: Sequence[str] = ("sensor_id",), order: str = "date", **options) -> DataFrame:
    """Daily features of single sensors; short windows count, a missing deviation becomes 0."""
    weekday = F.weekday(order)
    dated = df.select(
        "*", weekday.alias("dayofweek"), F.dayofmonth(order).alias("dayofmonth"), (weekday >= 5).alias("is_weekend")
    )
    out = series_features(dated, SENSOR_DAYS, keys, order, complete=False, **options)
    return out.fillna(0.0, subset=[f"pm_roll_std_{n}" for n in C.SENSOR_WINDOWS])


def city_features(df: DataFrame, keys: Sequence[str] = ("city",), order: str = "date", **options) -> DataFrame:
    """Rolling means of a city's daily weather."""
    return series_features(df, CITY_DAYS, keys, order, complete=False, **options)


# --- time-range features ----------------------------------------------------------------


def time_range_features(
    df: DataFrame, value: str = "pm25", keys: Sequence[str] = ("region",), order: str = "timestamp",
    lags: Sequence[int] = C.DAILY_LAGS, windows: Sequence[int] = C.DAILY_WINDOWS, tie: Sequence[str] = (),
    block_days: int = 512,
) -> DataFrame:
    """Features by distance in days instead of rows, for daily series with gaps.

    Lag k is the value exactly k days earlier (the last one, should a day have several),
    NULL if that day is missing.  Window w covers the days after ts - w and up to ts - 1,
    that is w - 1 days, with any number of values.
    """
    reach = max((*lags, *windows))
    dated = df.withColumn("_day", F.unix_date(F.to_date(order)).cast("bigint"))
    cut = day_blocks(dated, "_day", back_days=reach, block_days=block_days)
    by_day = Window.partitionBy(*keys, BLOCK).orderBy("_day")
    columns = []
    for n in lags:
        at = by_day.rangeBetween(-n, -n)
        # max_by over (tie columns) picks the last match; one value per day needs no tie.
        hit = F.max_by(value, F.struct(*tie)).over(at) if tie else F.last(value).over(at)
        columns.append(hit.alias(f"{value}_lag_{n}d"))
    for n in windows:
        frame = by_day.rangeBetween(-(n - 1), -1)
        for stat in ("mean", "min", "max", "std"):
            columns.append(_STATS[stat](value).over(frame).alias(f"{value}_rolling_{stat}_{n}d"))
    return own_rows(cut.select("*", *columns)).drop("_day")


# --- calendar gaps ----------------------------------------------------------------------


def missing_days(df: DataFrame, keys: Sequence[str], ts: str = "timestamp", tz: str | None = None) -> DataFrame:
    """Days between a key's first and last observation without any observation."""
    days = df.select(*keys, F.to_date(local_clock(F.col(ts), tz)).alias("day")).distinct()
    spans = days.groupBy(*keys).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = date_spine(spans, "first", "last").select(*keys, "day")
    return spine.join(days, [*keys, "day"], "left_anti")


def date_spine(df: DataFrame, first: str, last: str, out: str = "day") -> DataFrame:
    """One row per day for each row of ``df``, from column ``first`` to column ``last``."""
    return df.withColumn(out, F.explode(day_sequence(F.col(first), F.col(last))))
