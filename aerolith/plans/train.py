"""The training job: stored daily tables -> feature view -> one model per region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.constants import REGIONS
from aerolith.operators.joins import feature_view
from aerolith.operators.model import TreeParams, evaluate, fit_regions, save_model
from aerolith.operators.trees import store_tables
from aerolith.session import materialize
from aerolith.sources.tables import daily_tables


def train_regions(
    spark: SparkSession, root: str, test_start, regions: Sequence[str] = REGIONS, params: TreeParams = TreeParams(),
    version: int | None = None, model_version: int = 1,
) -> DataFrame:
    """Fit, evaluate and store a model per region; returns the metrics per region."""
    tables = daily_tables(spark, root, version, regions=regions)
    view = materialize(
        feature_view(
            tables["pm25_daily"], tables["wind_direction_daily"], tables["wind_speed_daily"],
            tables["air_temperature_daily"],
        )
    )
    models, scored = fit_regions(view, regions, test_start, params)
    metrics = materialize(evaluate(scored))
    for region, model in models.items():
        save_model(model, metrics.filter(F.col("region") == region).drop("region"), region, root, model_version, params)
        store_tables(model, region, root, model_version)
    return metrics
