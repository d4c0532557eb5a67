"""Time split, boosted-tree training per region, scoring, and stored models."""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.clean import align_features, complete_cases, numeric_columns
from aerolith.operators.metrics import regression_metrics
from aerolith.session import checkpoint_dir, materialize

PREDICTION = "predicted_pm25"

#: Rows of a training partition; a region of some hundred days is one, so that a round's jobs are of one task.
ROWS_PER_PARTITION = 50_000
#: Names of a feature's copies end in these: as it is, or with missing values below its least, above its largest one.
_AS_IS, _LOW, _HIGH = "__filled", "__low", "__high"


@dataclass(frozen=True)
class TreeParams:
    """Boosting parameters; the defaults are the production setting."""

    rounds: int = 3000
    learning_rate: float = 0.02
    max_depth: int = 5
    min_rows_per_leaf: int = 4
    row_fraction: float = 0.8
    column_fraction: float = 0.8
    seed: int = 42


def split_by_time(df: DataFrame, test_start, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """(train, test): complete rows before ``test_start``, all rows from it on."""
    start = F.lit(test_start).cast(df.schema[ts].dataType)
    return complete_cases(df.filter(F.col(ts) < start)), df.filter(F.col(ts) >= start)


def model_features(df: DataFrame, label: str = "pm25") -> list[str]:
    """All numeric columns but the label; key and flag columns are no numbers and drop out."""
    return numeric_columns(df, exclude=[label])


@dataclass(frozen=True)
class Copy:
    """A column that the trees see: a feature with its missing values filled."""

    name: str
    feature: str
    fill: float


def feature_copies(rows: DataFrame, features: Sequence[str]) -> list[Copy]:
    """The columns for the trees.  A feature that lacks values in ``rows`` gets two copies, one with missing values
    below all others and one above, so that a split can send them to either side.  Others are filled by their mean
    where a later row lacks them.  NaN counts as missing."""
    checks = []
    for i, c in enumerate(features):
        value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        checks += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"), F.avg(value).alias(f"m{i}")]
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), *checks).first()
    out = []
    for i, c in enumerate(features):
        low, high, mean = (float("nan") if seen[f"{s}{i}"] is None else seen[f"{s}{i}"] for s in ("lo", "hi", "m"))
        if seen[f"n{i}"] == seen["rows"] or not math.isfinite(high - low):
            out.append(Copy(f"{c}{_AS_IS}", c, float(mean) if math.isfinite(mean) else 0.0))
        else:
            step = max(1.0, high - low)
            out += [Copy(f"{c}{_LOW}", c, float(low - step)), Copy(f"{c}{_HIGH}", c, float(high + step))]
    return out


def _filling(copies: Sequence[Copy]) -> SQLTransformer:
    """A stage that adds the copies; its statement is stored with the model."""
    columns = [
        f"coalesce(nanvl(CAST(`{c.feature}` AS DOUBLE), CAST(NULL AS DOUBLE)), {c.fill!r}D) AS `{c.name}`" for c in copies
    ]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def fit(train: DataFrame, features: Sequence[str], label: str = "pm25", params: TreeParams = TreeParams()) -> PipelineModel:
    """Fill, assemble, boost.  Fitting is distributed over the rows of ``train``."""
    checkpoint_dir(train.sparkSession)  # long boosting runs cut their lineage there
    rows = materialize(align_features(train, features, keep=[F.col(label).cast("double").alias(label)]))
    copies = feature_copies(rows, features)
    filling = _filling(copies)
    assembler = VectorAssembler(inputCols=[c.name for c in copies], outputCol="features", handleInvalid="keep")
    booster = GBTRegressor(
        featuresCol="features", labelCol=label, predictionCol=PREDICTION,
        maxIter=params.rounds, stepSize=params.learning_rate, maxDepth=params.max_depth,
        minInstancesPerNode=params.min_rows_per_leaf, subsamplingRate=params.row_fraction,
        featureSubsetStrategy=str(params.column_fraction), seed=params.seed,
    )
    rows = rows.coalesce(-(-rows.count() // ROWS_PER_PARTITION) or 1)
    # Every task of the rounds' thousands of jobs carries the lineage of what it reads: it starts at these files.
    vectors = assembler.transform(filling.transform(rows)).select("features", label).checkpoint()
    return PipelineModel([filling, assembler, booster.fit(vectors)])


def copies_of(model: PipelineModel) -> list[Copy]:
    """The columns that a model's trees see, in the order of their numbers."""
    found = re.findall(r", (-?[0-9.e+-]+)D\) AS `([^`]*)`", model.stages[0].getStatement())
    fills = {name: float(fill) for fill, name in found}
    names = list(model.stages[1].getInputCols())
    return [Copy(n, n.removesuffix(_AS_IS).removesuffix(_LOW).removesuffix(_HIGH), fills[n]) for n in names]


def features_of(model: PipelineModel) -> list[str]:
    return list(dict.fromkeys(c.feature for c in copies_of(model)))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the prediction; features the table lacks count as missing."""
    features, present = features_of(model), set(df.columns)
    others = [F.col(c) for c in df.columns if c not in features]
    kept = [F.col(c).alias(f"{c}__kept") for c in features if c in present]
    numbers = [(F.col(c) if c in present else F.lit(None)).cast("double").alias(c) for c in features]
    scored = model.transform(df.select(*others, *kept, *numbers))
    return scored.select(*[F.col(f"{c}__kept").alias(c) if c in features else F.col(c) for c in df.columns], PREDICTION)


def fit_regions(
    view: DataFrame, regions: Sequence[str], test_start, params: TreeParams = TreeParams(), label: str = "pm25",
    at_once: int = 5,
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """One model per region and the scored test rows of all regions.

    ``view`` is written by region first, so that each fit reads its own region's files.  ``at_once`` fits run side
    by side: a round of boosting is a few short jobs, and a single fit leaves most of a cluster idle between them.
    """
    features = model_features(view, label)
    stored = materialize(view.filter(F.col("region").isin(list(regions))), by=["region"])

    def one(region: str) -> PipelineModel:
        train, _ = split_by_time(stored.filter(F.col("region") == region), test_start)
        return fit(train, features, label, params)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(regions)))) as pool:
        # A target of its own for each task: it carries the session's properties into the thread.
        fitted = list(pool.map(lambda region: inheritable_thread_target(view.sparkSession)(one)(region), regions))
    models, tests = dict(zip(regions, fitted, strict=True)), None
    for region, model in models.items():
        _, test = split_by_time(stored.filter(F.col("region") == region), test_start)
        scored = score(model, test)
        tests = scored if tests is None else tests.unionByName(scored)
    return models, tests


def feature_importance(model: PipelineModel, spark: SparkSession, top: int = 15) -> DataFrame:
    """The most useful features by impurity gain (one row per feature, at most ``top``)."""
    weights = dict.fromkeys(features_of(model), 0.0)
    for copy, weight in zip(copies_of(model), model.stages[-1].featureImportances.toArray().tolist()):
        weights[copy.feature] += weight
    rows = list(weights.items())
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    ).limit(top)


def described_splits(model: PipelineModel) -> dict[str, int]:
    """How often the trees split on each feature, by the model's own description."""
    copies, counts = copies_of(model), {}
    for position in re.findall(r"If \(feature (\d+) ", model.stages[-1].toDebugString):
        feature = copies[int(position)].feature
        counts[feature] = counts.get(feature, 0) + 1
    return counts


def _model_path(root: str, region: str, version: int) -> str:
    return f"{root.rstrip('/')}/models/pm25_trees_{region}/v={version}"


def save_model(
    model: PipelineModel, metrics: DataFrame, region: str, root: str, version: int = 1, params: TreeParams | None = None
) -> None:
    """Store a model with its metrics table beside it."""
    path = _model_path(root, region, version)
    model.write().overwrite().save(f"{path}/model")
    noted = metrics
    for name, value in asdict(params).items() if params else ():
        noted = noted.withColumn(name, F.lit(value))
    noted.withColumn("region", F.lit(region)).write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(root: str, region: str, version: int = 1) -> PipelineModel:
    return PipelineModel.load(f"{_model_path(root, region, version)}/model")


def load_metrics(spark: SparkSession, root: str, region: str, version: int = 1) -> DataFrame:
    return spark.read.parquet(f"{_model_path(root, region, version)}/metrics")


def evaluate(scored: DataFrame, label: str = "pm25", keys: Sequence[str] = ("region",)) -> DataFrame:
    return regression_metrics(scored, label, PREDICTION, keys)
