"""The forecasting job: stored tables and models -> stored predictions -> hindcast."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.constants import REGIONS
from aerolith.operators.forecast import Scorer, forecast_regions, forecast_state
from aerolith.operators.joins import future_weather, hindcast, join_series_with_suffixes, last_rows
from aerolith.operators.metrics import regression_metrics
from aerolith.operators.model import PREDICTION, score
from aerolith.operators.trees import load_tables, tree_scorer
from aerolith.schemas import FEATURE_TABLES
from aerolith.session import materialize
from aerolith.sinks.tables import upsert
from aerolith.sources.tables import daily_tables, read_table


def weekly_forecast(
    spark: SparkSession, root: str, as_of, models: Scorer | Mapping[str, PipelineModel | Scorer],
    days: int = 7, version: int | None = None, shortened: bool = False, regions: Sequence[str] | None = None,
) -> DataFrame:
    """Forecasts of all regions from ``as_of`` on, by each region's own model or scorer, or by a scorer for all."""
    if isinstance(models, Mapping):
        regions = list(models)
        scorers = {region: model if callable(model) else partial(score, model) for region, model in models.items()}
    else:
        scorers = models
    tables = daily_tables(spark, root, version, regions=regions)
    weather = future_weather(
        tables["wind_direction_daily"], tables["wind_speed_daily"], tables["air_temperature_daily"], as_of, days
    ).drop("days_before_forecast_day")
    state = forecast_state(tables["pm25_daily"], weather, as_of, days)
    return forecast_regions(state, scorers, days, shortened)


def predict_and_store(
    spark: SparkSession, root: str, as_of, regions: Sequence[str] = REGIONS, days: int = 7,
    version: int | None = None, model_version: int = 1, shortened: bool = False,
) -> DataFrame:
    """Read the stored models as tables, forecast, upsert the predictions; returns them."""
    scorer = tree_scorer(*load_tables(spark, root, regions, model_version))
    forecast = weekly_forecast(spark, root, as_of, scorer, days, version, shortened, regions)
    return store_forecast(spark, forecast, root)


def store_forecast(spark: SparkSession, forecast: DataFrame, root: str) -> DataFrame:
    predictions = materialize(forecast)
    upsert(predictions, FEATURE_TABLES["aq_predictions"], root)
    return predictions


def stored_hindcast(spark: SparkSession, root: str, region: str | None = None) -> DataFrame:
    """All stored predictions with the outcomes of their days."""
    only = None if region is None else [region]
    predictions = read_table(spark, root, "aq_predictions", regions=only)
    outcomes = read_table(spark, root, "pm25_daily", regions=only)
    return hindcast(predictions, outcomes)


def hindcast_metrics(joined: DataFrame) -> DataFrame:
    """Error per region and forecast horizon."""
    return regression_metrics(joined, "pm25", PREDICTION, ["region", "days_before_forecast_day"])


def monitoring_backfill(
    direction: DataFrame, speed: DataFrame, temperature: DataFrame, pm25: DataFrame, models, region: str | None = None,
    rows: int = 10,
) -> DataFrame:
    """Score the latest days of each region after the fact, as one-day-ahead predictions.

    ``models``: one scorer (DataFrame -> DataFrame with the prediction) or a mapping by region.
    """
    tables = [t if region is None else t.filter(F.col("region") == region) for t in (direction, speed, temperature, pm25)]
    joined = join_series_with_suffixes(tables[0], [("_ws", tables[1]), ("_at", tables[2]), ("_pm", tables[3])])
    latest = last_rows(joined, rows)
    if isinstance(models, Mapping):
        scored = None
        for name, scorer in models.items():
            part = scorer(latest.filter(F.col("region") == name))
            scored = part if scored is None else scored.unionByName(part)
    else:
        scored = models(latest)
    return scored.withColumn("days_before_forecast_day", F.lit(1))
