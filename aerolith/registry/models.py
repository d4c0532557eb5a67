"""Forecasts and models (M2-M8)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from aerolith.operators.features import add_calendar, table_features
from aerolith.operators.forecast import forecast_regions, forecast_state, linear_scorer, recursive_forecast
from aerolith.operators.joins import feature_view
from aerolith.operators.model import (
    TreeParams, evaluate, feature_importance, fit, fit_regions, load_metrics, load_model, model_features, save_model,
    described_splits, score, split_by_time,
)
from aerolith.operators.trees import load_tables, score_trees, split_counts, store_tables, tree_scorer
from aerolith.plans.predict import store_forecast, stored_hindcast, weekly_forecast
from aerolith.plans.series import store_series
from aerolith.registry import query
from aerolith.registry import adapters as a
from aerolith.session import materialize, work_path
from aerolith.sources.tables import read_table

AS_OF = "2001-01-01"
REGION_NAMES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
WEIGHTS = {"pm25_lag_1d": 0.5, "pm25_lag_7d": 0.1, "pm25_rolling_mean_7d": 0.3, "wind_speed_avg_mean": 0.2}


def _forecast_sql(shortened: bool) -> str:
    """The recursion unrolled: each step reads the history with all earlier predictions."""
    steps = []
    for k in range(1, 8):
        before = f"history_{k - 1}"
        window = (
            f"""SELECT n.region, avg(h.pm25) AS m FROM next_{k} n JOIN {before} h ON h.region = n.region
                AND h."timestamp" > n."timestamp" - INTERVAL 7 DAYS AND h."timestamp" <= n."timestamp" - INTERVAL 1 DAY
                GROUP BY 1"""
            if shortened
            else f"""SELECT region, CASE WHEN count(*) >= 3 THEN avg(pm25) END AS m FROM (
                SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp" DESC) AS rn FROM {before})
                WHERE rn <= 7 GROUP BY 1"""
        )
        lags = " ".join(
            f"""LEFT JOIN {before} l{n} ON l{n}.region = w.region AND l{n}."timestamp" = w."timestamp" - INTERVAL {n} DAYS"""
            for n in (1, 7)
        )
        steps.append(
            f"""next_{k} AS MATERIALIZED (SELECT * FROM ahead WHERE n = {k}),
            window_{k} AS MATERIALIZED ({window}),
            step_{k} AS MATERIALIZED (SELECT w.region, w."timestamp", {k} AS k,
              0.5e0 * coalesce(l1.pm25, 0) + 0.1e0 * coalesce(l7.pm25, 0) + 0.3e0 * coalesce(x.m, 0)
              + 0.2e0 * w.wind_speed_avg_mean AS pm25
              FROM next_{k} w {lags} LEFT JOIN window_{k} x ON x.region = w.region),
            history_{k} AS MATERIALIZED (SELECT * FROM {before} UNION ALL SELECT region, "timestamp", pm25 FROM step_{k})"""
        )
    union = " UNION ALL ".join(f"SELECT * FROM step_{k}" for k in range(1, 8))
    return f"""WITH {a.DAILY},
    ahead AS MATERIALIZED (SELECT * FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY "timestamp") AS n FROM weather
      WHERE "timestamp" >= TIMESTAMP '{AS_OF}') WHERE n <= 7),
    history_0 AS MATERIALIZED (SELECT region, "timestamp", pm25 FROM daily WHERE "timestamp" < TIMESTAMP '{AS_OF}'),
    {', '.join(steps)}
    SELECT region, "timestamp", CAST(k AS INTEGER) AS days_before_forecast_day, {a.sql_round('pm25', 'predicted_pm25')}
    FROM ({union})"""


def _linear(spark, sf_dir, shortened: bool):
    state = forecast_state(a.daily(spark, sf_dir), a.weather(spark, sf_dir), F.lit(AS_OF).cast("timestamp_ntz"))
    return a.rounded(recursive_forecast(state, linear_scorer(WEIGHTS), shortened=shortened))


@query("recursive_forecast_linear", _forecast_sql(False))
def recursive_forecast_linear(spark, sf_dir):
    return _linear(spark, sf_dir, shortened=False)


@query("recursive_forecast_short_windows", _forecast_sql(True))
def recursive_forecast_short_windows(spark, sf_dir):
    return _linear(spark, sf_dir, shortened=True)


def _training_view(spark, sf_dir):
    t = a.daily_tables(spark, sf_dir)
    pm25 = table_features(add_calendar(t["pm25"], with_hour=False), "pm25_daily")
    return t, materialize(feature_view(pm25, t["direction"], t["speed"], t["temperature"]))


# The production setting but for the rounds, of all queries but gbt_test_metrics: README has the seconds of a round.
ROUNDS = 60
_PARAMS = TreeParams(rounds=ROUNDS)


@query("gbt_forecast")
def gbt_forecast(spark, sf_dir):
    """Fit a model per region, store and load it, and forecast a week with each."""
    tables, view = _training_view(spark, sf_dir)
    models, scored = fit_regions(view, REGION_NAMES, AS_OF, _PARAMS)
    metrics, root = materialize(evaluate(scored)), work_path(spark, "models")
    for region, model in models.items():
        save_model(model, metrics.filter(F.col("region") == region).drop("region"), region, root, params=_PARAMS)
        store_tables(model, region, root)
    scorer = tree_scorer(*load_tables(spark, root, REGION_NAMES))
    weather = tables["direction"].join(tables["speed"], ["region", "timestamp"]).join(
        tables["temperature"], ["region", "timestamp"]
    )
    state = forecast_state(tables["pm25"], weather, F.lit(AS_OF).cast("timestamp_ntz"))
    return forecast_regions(state, scorer)


@query("gbt_test_metrics")
def gbt_test_metrics(spark, sf_dir):
    """How well the production setting predicts, fitted with all of its rounds."""
    _, view = _training_view(spark, sf_dir)
    _, scored = fit_regions(view, REGION_NAMES, AS_OF, TreeParams())
    return evaluate(scored)


@query("feature_importance")
def importance(spark, sf_dir):
    """Importances of one model for all regions together."""
    _, view = _training_view(spark, sf_dir)
    train, _ = split_by_time(view, AS_OF)
    return feature_importance(fit(train, model_features(view), params=_PARAMS), spark)


def _stored_tables(spark, sf_dir, root: str) -> None:
    tables = a.daily_tables(spark, sf_dir)
    for name, key in (
        ("pm25_daily", "pm25"), ("wind_direction_daily", "direction"), ("wind_speed_daily", "speed"),
        ("air_temperature_daily", "temperature"),
    ):
        store_series(spark, tables[key], name, root)


@query(
    "weekly_forecast_stored",
    f"""WITH {a.DAILY}, forecast AS ({_forecast_sql(False)})
    SELECT f.region, f."timestamp", f.days_before_forecast_day, f.predicted_pm25, {a.sql_round('d.pm25', 'pm25')}
    FROM forecast f JOIN daily d ON d.region = f.region AND d."timestamp" = f."timestamp" """,
)
def weekly_forecast_stored(spark, sf_dir):
    """The week's forecast from stored tables, stored twice, and read back beside the outcomes of its days."""
    root = work_path(spark, "weekly")
    _stored_tables(spark, sf_dir, root)
    scorers = {region: linear_scorer(WEIGHTS) for region in REGION_NAMES}
    predictions = store_forecast(spark, weekly_forecast(spark, root, F.lit(AS_OF).cast("timestamp_ntz"), scorers), root)
    store_forecast(spark, predictions, root)
    out = stored_hindcast(spark, root)
    return a.rounded(out.select("region", "timestamp", "days_before_forecast_day", "predicted_pm25", "pm25"))


@query(
    "gbt_model_properties",
    """SELECT r_name AS region, 7 AS steps, 1 AS first_step, 7 AS last_step, 0 AS missing, TRUE AS loaded_scores_equal,
      TRUE AS stored_metrics_equal, 1e0 AS importance_sum, TRUE AS importances_sorted, TRUE AS table_scores_equal,
      TRUE AS splits_as_described FROM region""",
)
def gbt_model_properties(spark, sf_dir):
    """What must hold of every region's model, whatever the trees: the forecast's rows and horizons, a loaded model
    that scores as the fitted one, metrics that the scored rows give again, importances that sum to one, trees as tables
    that score all regions in one plan as the models do, and as many splits by feature as the models describe."""
    tables, view = _training_view(spark, sf_dir)
    models, scored = fit_regions(view, REGION_NAMES, AS_OF, _PARAMS)
    scored, root = materialize(scored), work_path(spark, "model_properties")
    metrics = materialize(evaluate(scored))
    rows = []
    for region, model in models.items():  # one row a region reaches the driver
        save_model(model, metrics.filter(F.col("region") == region).drop("region"), region, root, params=_PARAMS)
        store_tables(model, region, root)
        loaded, mine = load_model(root, region), scored.filter(F.col("region") == region)
        again = score(loaded, mine.withColumnRenamed("predicted_pm25", "_fitted"))
        differing = again.filter(~F.col("predicted_pm25").eqNullSafe(F.col("_fitted"))).count()
        error = mine.agg(F.avg((F.col("pm25") - F.col("predicted_pm25")) ** 2)).first()[0]
        stored = load_metrics(spark, root, region).first()
        weights = [r.importance for r in feature_importance(loaded, spark, top=1000).collect()]
        rows.append(
            (region, differing == 0, abs(stored.mse - error) < 1e-9 * max(1.0, error), round(sum(weights), 6),
             weights == sorted(weights, reverse=True))
        )
    trees, inputs = load_tables(spark, root, REGION_NAMES)
    again = score_trees(scored.withColumnRenamed("predicted_pm25", "_fitted"), trees, inputs)
    apart = F.coalesce(F.abs(F.col("predicted_pm25") - F.col("_fitted")) > 1e-9, F.lit(True))
    differing = {r.region: r.n for r in again.groupBy("region").agg(F.sum(apart.cast("int")).alias("n")).collect()}
    counted: dict[str, dict[str, int]] = {}
    for row in split_counts(trees, inputs, top=1000).collect():  # features of five models
        counted.setdefault(row.region, {})[row.feature] = row.splits
    rows = [(*r, differing[r[0]] == 0, counted[r[0]] == described_splits(models[r[0]])) for r in rows]
    weather = tables["direction"].join(tables["speed"], ["region", "timestamp"]).join(tables["temperature"], ["region", "timestamp"])
    state = forecast_state(tables["pm25"], weather, F.lit(AS_OF).cast("timestamp_ntz"))
    forecast = forecast_regions(state, {r: partial(score, m) for r, m in models.items()})
    step = F.col("days_before_forecast_day")
    steps = forecast.groupBy("region").agg(
        F.count("*").cast("int").alias("steps"), F.min(step).alias("first_step"), F.max(step).alias("last_step"),
        F.sum(F.col("predicted_pm25").isNull().cast("int")).cast("int").alias("missing"),
    )
    kinds = "region string, loaded_scores_equal boolean, stored_metrics_equal boolean, importance_sum double, importances_sorted boolean"
    kinds += ", table_scores_equal boolean, splits_as_described boolean"
    return steps.join(spark.createDataFrame(rows, kinds), "region")
