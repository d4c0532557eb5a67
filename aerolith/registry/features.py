"""Feature builders (F1-F12), windows (W1-W9), time-range lookups."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from aerolith.operators import features as f
from aerolith.registry import query
from aerolith.registry import adapters as a

# What the SQL expects of each table, as numbers of its own: a wrong constant in the library turns rows red.
_EXPECTED = {
    **{t: ((1, 2, 3, 4, 5, 6, 7, 14, 28), (3, 7, 14, 28))
       for t in ("pm25_daily", "wind_direction_daily", "wind_speed_daily", "air_temperature_daily")},
    **{t: ((1, 2, 3, 6, 12, 24, 48, 72, 168), (6, 12, 24, 72, 168))
       for t in ("wind_direction_hourly", "wind_speed_hourly", "air_temperature_hourly")},
    "pm25_hourly": ((1, 2, 3, 6, 12, 24), (6, 12, 24, 72, 168)),
}


def _expected(table: str) -> f.SeriesSpec:
    lags, windows = _EXPECTED[table]
    return replace(f.SERIES[table], lags=lags, windows=windows, min_periods="half")


_SQL_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _calendar_sql(ts: str, with_hour: bool, wide: bool = False) -> list[tuple[str, str]]:
    """(name, SQL) of the calendar columns; ``wide`` for plain integers."""
    kind = "INTEGER" if wide else "TINYINT"
    weekend = f"isodow({ts}) - 1 >= 5"
    hour = [("hour", f"CAST(hour({ts}) AS {kind})")] if with_hour else []
    return hour + [
        ("day_of_week", f"CAST(isodow({ts}) - 1 AS {kind})"),
        ("day_of_month", f"CAST(day({ts}) AS {kind})"),
        ("month", f"CAST(month({ts}) AS {kind})"),
        ("year", f"CAST(year({ts}) AS INTEGER)"),
        ("is_weekend", f"CAST({weekend} AS INTEGER)" if wide else weekend),
    ]


def _window_sql(spec: f.SeriesSpec, keys: list[str], order: str) -> list[tuple[str, str]]:
    over = f"PARTITION BY {', '.join(keys)} ORDER BY {order}"
    out = []
    for n in spec.lags:
        for name, source in spec.lagged:
            out.append((spec.lag_pattern.format(name=name, n=n, unit=spec.unit), f"lag({source}, {n}) OVER ({over})"))
    for n in spec.windows:
        needed = {"half": max(1, n // 2), "full": n}.get(spec.min_periods, spec.min_periods)
        frame = f"OVER ({over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for name, source, stats in spec.rolled:
            for stat in stats:
                alias = spec.roll_pattern.format(name=name, stat=stat, n=n, unit=spec.unit)
                value = f"{_SQL_STATS[stat]}({source}) {frame}"
                out.append((alias, f"CASE WHEN count({source}) {frame} >= {needed} THEN {value} END"))
    for n in spec.horizons:
        out.append((f"target_{n // 24}d", f"lead({spec.target}, {n}) OVER ({over})"))
    return out


def _features_sql(
    with_part: str, source: str, spec: f.SeriesSpec, base: list[str], keys: list[str], order: str,
    calendar: list[tuple[str, str]] = (), plain: list[str] = (), complete: bool = True, fill: dict[str, str] | None = None,
) -> str:
    """Features over ``source`` in SQL; ``plain`` columns and the calendar are not rounded."""
    direction = spec.components_of
    components = [("wind_u", f"-sin(radians({direction}))"), ("wind_v", f"-cos(radians({direction}))")] if direction else []
    inner = ", ".join(f"{e} AS {n}" for n, e in components)
    src = f"(SELECT *, {inner} FROM {source})" if inner else source
    derived = _window_sql(spec, keys, order)
    computed = ", ".join(f'{e} AS "{n}"' for n, e in [*calendar, *derived])
    columns = [f'"{c}"' for c in plain] + [f'"{n}"' for n, _ in calendar]
    for name in [*base, *[n for n, _ in components], *[n for n, _ in derived]]:
        value = f'coalesce("{name}", {fill[name]})' if fill and name in fill else f'"{name}"'
        columns.append(a.sql_round(value, name))
    names = [*plain, *base, *[n for n, _ in calendar], *[n for n, _ in components], *[n for n, _ in derived]]
    where = "WHERE " + " AND ".join(f'"{n}" IS NOT NULL' for n in names) if complete else ""
    return f"WITH {with_part}, wide AS (SELECT *, {computed} FROM {src} s) SELECT {', '.join(columns)} FROM wide {where}"


def _register_table(name: str, table: str, base: list[str], hourly: bool, source) -> None:
    with_part, relation, load = source
    sql = _features_sql(
        with_part, relation, _expected(table), base, ["region"], '"timestamp"',
        _calendar_sql('"timestamp"', hourly), ["region", "timestamp"],
    )

    def run(spark, sf_dir):
        series = load(spark, sf_dir).select("region", "timestamp", *base)
        return a.rounded(f.table_features(f.add_calendar(series, hourly), table))

    query(name, sql)(run)


_DAILY = (a.DAILY, "daily", a.daily)
_WEATHER = (a.DAILY, "weather", a.weather)
_HOURLY = (a.HOURLY, "hourly", a.hourly)
_DIRECTION = (a.HOURLY, "hourly_direction", a.hourly_direction)

_register_table("features_pm25_daily", "pm25_daily", ["pm25"], False, _DAILY)
_register_table("features_pm25_hourly", "pm25_hourly", ["pm25"], True, _HOURLY)
_register_table(
    "features_wind_direction_hourly", "wind_direction_hourly", ["wind_direction_avg", "wind_direction_std"], True,
    _DIRECTION,
)
_register_table("features_wind_speed_hourly", "wind_speed_hourly", ["wind_speed_avg"], True, _HOURLY)
_register_table("features_air_temperature_hourly", "air_temperature_hourly", ["air_temperature_avg"], True, _HOURLY)
_register_table(
    "features_wind_direction_daily", "wind_direction_daily", ["wind_direction_avg_mean", "wind_direction_avg_std"], False,
    _WEATHER,
)
_register_table("features_wind_speed_daily", "wind_speed_daily", ["wind_speed_avg_mean"], False, _WEATHER)
_register_table("features_air_temperature_daily", "air_temperature_daily", ["air_temperature_avg_mean"], False, _WEATHER)


@query(
    "features_seasonal_hour",
    _features_sql(
        a.HOURLY + ", seasonal AS (SELECT *, CAST(hour(\"timestamp\") AS TINYINT) AS hour FROM hourly)", "seasonal",
        _expected("pm25_hourly"), ["pm25"], ["region", "hour"], '"timestamp"', [], ["region", "timestamp", "hour"],
        complete=False,
    ),
)
def features_seasonal_hour(spark, sf_dir):
    """All lags and windows per hour of day; the 30 days of the readings complete few rows, so all are kept."""
    series = a.hourly(spark, sf_dir).select("region", "timestamp", "pm25")
    series = series.withColumn("hour", F.hour("timestamp").cast("tinyint"))
    return a.rounded(f.seasonal_features(series, "pm25_hourly", complete=False))


# Single readings: no bound on rows per key, hence blocks.
_READINGS = replace(
    f.SERIES["pm25_hourly"], lagged=(("value", "wind_speed"),), rolled=(("value", "wind_speed", f.ALL_STATS),), rows_per_key=None,
    lag_pattern="{name}_lag_{n}", roll_pattern="{name}_rolling_{stat}_{n}",
)


@query(
    "features_blocked_readings",
    _features_sql(
        a.READINGS, "readings", replace(_READINGS, lags=(1, 2, 3, 6, 12, 24), windows=(6, 12, 24, 72, 168), min_periods="half"), ["wind_speed"], ["event_type"], '"timestamp", event_id', [],
        ["event_type", "timestamp", "event_id"],
    ),
)
def features_blocked_readings(spark, sf_dir):
    r = a.readings(spark, sf_dir).select("event_type", "timestamp", "event_id", "wind_speed")
    return a.rounded(
        f.series_features(r, _READINGS, ("event_type",), block_rows=1_000, tie=("event_id",))
    )


@query(
    "multi_horizon_targets",
    _features_sql(
        a.HOURLY, "hourly",
        replace(f.TARGETS, lags=(1, 3, 6, 12, 24, 48, 72, 168), windows=(24, 72, 168), horizons=(24, 48, 72, 96, 120, 144, 168)),
        ["pm25"], ["region"], '"timestamp"', _calendar_sql('"timestamp"', True, True),
        ["region", "timestamp"],
    ),
)
def multi_horizon_targets(spark, sf_dir):
    return a.rounded(f.multi_horizon_targets(a.hourly(spark, sf_dir).select("region", "timestamp", "pm25")))


_SENSOR_WITH = a.READINGS + """, sensor AS (
  SELECT user_id AS sensor_id, CAST("timestamp" AS DATE) AS date, avg(wind_speed) AS pm25 FROM readings GROUP BY 1, 2)"""


@query(
    "sensor_features_early",
    _features_sql(
        _SENSOR_WITH, "sensor", replace(f.SENSOR_DAYS, lags=(1, 2, 3, 7), windows=(3, 7)), ["pm25"], ["sensor_id"], "date",
        [("dayofweek", "CAST(isodow(date) - 1 AS INTEGER)"), ("dayofmonth", "CAST(day(date) AS INTEGER)"),
         ("is_weekend", "isodow(date) - 1 >= 5")],
        ["sensor_id", "date"], complete=False, fill={f"pm_roll_std_{n}": "0" for n in (3, 7)},
    ),
)
def sensor_features_early(spark, sf_dir):
    days = a.readings(spark, sf_dir).groupBy(F.col("user_id").alias("sensor_id"), F.to_date("timestamp").alias("date"))
    return a.rounded(f.sensor_features(days.agg(F.avg("wind_speed").alias("pm25"))))


@query(
    "city_rolling",
    _features_sql(
        a.DAILY + """, city AS (SELECT region AS city, CAST("timestamp" AS DATE) AS date,
          air_temperature_avg_mean AS temperature_2m_mean, wind_speed_avg_mean AS wind_speed_10m_max FROM weather)""",
        "city", replace(f.CITY_DAYS, lags=(), windows=(3, 7), min_periods=1), ["temperature_2m_mean", "wind_speed_10m_max"], ["city"], "date", [], ["city", "date"],
        complete=False,
    ),
)
def city_rolling(spark, sf_dir):
    w = a.weather(spark, sf_dir).select(
        F.col("region").alias("city"), F.to_date("timestamp").alias("date"),
        F.col("air_temperature_avg_mean").alias("temperature_2m_mean"),
        F.col("wind_speed_avg_mean").alias("wind_speed_10m_max"),
    )
    return a.rounded(f.city_features(w))


_CALENDAR_COLUMNS = ", ".join(
    f"{e} AS {n}" for n, e in _calendar_sql('"timestamp" + INTERVAL 8 HOURS', True)
)


@query(
    "calendar_features",
    f'WITH {a.READINGS} SELECT event_id, "timestamp", {_CALENDAR_COLUMNS} FROM readings',
)
def calendar_features(spark, sf_dir):
    r = a.readings(spark, sf_dir).select("event_id", "timestamp")
    return f.add_calendar(r, with_hour=True, tz="Asia/Singapore", source_tz="UTC")


def _time_range_sql() -> str:
    columns = ["d.region", 'd."timestamp"', a.sql_round("d.pm25", "pm25")]
    joins = []
    for n in (1, 2, 3, 4, 5, 6, 7, 14, 28):
        joins.append(
            f'LEFT JOIN daily l{n} ON l{n}.region = d.region AND l{n}."timestamp" = d."timestamp" - INTERVAL {n} DAYS'
        )
        columns.append(a.sql_round(f"l{n}.pm25", f"pm25_lag_{n}d"))
    for n in (3, 7, 14, 28):
        frame = (
            f'OVER (PARTITION BY d.region ORDER BY d."timestamp" '
            f"RANGE BETWEEN INTERVAL {n - 1} DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING)"
        )
        for stat, function in _SQL_STATS.items():
            columns.append(a.sql_round(f"{function}(d.pm25) {frame}", f"pm25_rolling_{stat}_{n}d"))
    return f"WITH {a.DAILY} SELECT {', '.join(columns)} FROM daily d {' '.join(joins)}"


@query("time_range_features", _time_range_sql())
def time_range_features(spark, sf_dir):
    return a.rounded(f.time_range_features(a.daily(spark, sf_dir)))


@query(
    "exact_day_lags",
    f"""WITH {a.DAILY}, f AS (
      SELECT region, "timestamp", pm25, lag(pm25, 1) OVER (PARTITION BY region ORDER BY "timestamp") AS row_lag FROM daily)
    SELECT f.region, f."timestamp", {a.sql_round('f.row_lag', 'pm25_row_lag_1')}, {a.sql_round('e.pm25', 'pm25_lag_1d')}
    FROM f LEFT JOIN daily e ON e.region = f.region AND e."timestamp" = f."timestamp" - INTERVAL 1 DAYS""",
)
def exact_day_lags(spark, sf_dir):
    one = replace(
        f.SERIES["pm25_daily"], lags=(1,), windows=(), rolled=(), lag_pattern="pm25_row_lag_{n}",
    )
    rows = f.series_features(a.daily(spark, sf_dir), one, complete=False)
    out = f.time_range_features(rows, lags=(1,), windows=())
    return a.rounded(out.select("region", "timestamp", "pm25_row_lag_1", "pm25_lag_1d"))


@query(
    "missing_days",
    f"""WITH {a.DAILY}, spans AS (
      SELECT region, CAST(min("timestamp") AS DATE) AS lo, CAST(max("timestamp") AS DATE) AS hi FROM daily GROUP BY 1),
    spine AS (SELECT region, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM spans)
    SELECT s.region, s.day FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM daily d WHERE d.region = s.region AND CAST(d."timestamp" AS DATE) = s.day)""",
)
def missing_days(spark, sf_dir):
    return f.missing_days(a.placed_orders(spark, sf_dir), ["region"])
