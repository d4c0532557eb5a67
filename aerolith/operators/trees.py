"""Boosted trees as tables: one plan scores the rows of all keys, each by its own model.

A stored model is two small tables.  ``trees``: a row per tree, its nodes as arrays by node
number.  ``inputs``: a row per column that the trees see, with the feature behind it and what
stands for a missing value.  Both carry the model's key, so that models are rows like any
others: scoring joins on the key, and the plan doesn't depend on how many models there are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators.model import PREDICTION, Copy, _model_path, copies_of

_TREES = "tree int, weight double, feature array<int>, threshold array<double>, left array<int>, right array<int>, value array<double>"
_INPUTS = "position int, feature string, fill double"


def tree_table(spark: SparkSession, path: str) -> DataFrame:
    """The trees of a pipeline that was saved to ``path``, boosting as its last stage; a leaf has no left child."""
    stage = f"{path}/stages/2_*"
    # treeID and nodes of each tree; a tree of depth d has at most 2 ** (d + 1) - 1 of them.
    nodes = spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*")
    node = F.struct(
        "id", F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), F.col("prediction").alias("value"),
    )
    trees = nodes.groupBy("treeID").agg(F.sort_array(F.collect_list(node)).alias("n"))
    weights = spark.read.parquet(f"{stage}/treesMetadata")
    weights = weights.select(F.col(weights.columns[0]).alias("treeID"), F.col(weights.columns[2]).alias("weight"))
    fields = [F.col(f"n.{f}").alias(f) for f in ("feature", "threshold", "left", "right", "value")]
    return trees.join(weights, "treeID").select(F.col("treeID").alias("tree"), "weight", *fields)


def input_table(spark: SparkSession, copies: Sequence[Copy]) -> DataFrame:
    return spark.createDataFrame([(i, c.feature, c.fill) for i, c in enumerate(copies)], _INPUTS)


def store_tables(model: PipelineModel, region: str, root: str, version: int = 1) -> None:
    """Write the tables of a model beside it; ``save_model`` came before."""
    spark, path = SparkSession.active(), _model_path(root, region, version)
    tree_table(spark, f"{path}/model").withColumn("region", F.lit(region)).write.mode("overwrite").parquet(f"{path}/trees")
    inputs = input_table(spark, copies_of(model))
    inputs.withColumn("region", F.lit(region)).write.mode("overwrite").parquet(f"{path}/inputs")


def load_tables(spark: SparkSession, root: str, regions: Sequence[str], version: int = 1) -> tuple[DataFrame, DataFrame]:
    """(trees, inputs) of the models of ``regions``."""
    paths = [_model_path(root, region, version) for region in regions]
    trees = spark.read.schema(f"{_TREES}, region string").parquet(*[f"{p}/trees" for p in paths])
    return trees, spark.read.schema(f"{_INPUTS}, region string").parquet(*[f"{p}/inputs" for p in paths])


def split_counts(trees: DataFrame, inputs: DataFrame, key: str = "region", top: int = 15) -> DataFrame:
    """key, feature, splits: the features that each model splits on most often, at most ``top``; ties by name."""
    used = trees.select(key, F.explode(F.arrays_zip("feature", "left")).alias("_node")).filter("_node.left >= 0")
    counts = used.groupBy(key, F.col("_node.feature").alias("position")).agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(inputs.select(key, "position", "feature"), [key, "position"])
    splits = named.groupBy(key, "feature").agg(F.sum("n").alias("splits"))
    best = Window.partitionBy(key).orderBy(F.desc("splits"), "feature")
    return splits.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= top).drop("_rank")


def _numbers(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def _leaf(tree: Column, features: Column) -> Column:
    """What a tree says: from the root, left while the feature doesn't exceed the threshold."""

    def step(node: Column, _: Column) -> Column:
        value, split = F.get(features, F.get(tree["feature"], node)), F.get(tree["threshold"], node)
        onward = F.when(value <= split, F.get(tree["left"], node)).otherwise(F.get(tree["right"], node))
        return F.when(F.get(tree["left"], node) >= 0, onward).otherwise(node)

    return F.get(tree["value"], F.aggregate(F.sequence(F.lit(1), tree["depth"]), F.lit(0), step))


def score_trees(
    df: DataFrame, trees: DataFrame, inputs: DataFrame, depth: int = 5, key: str = "region", out: str = PREDICTION
) -> DataFrame:
    """``df`` with the prediction of the model of its key; NULL for keys without one.

    ``depth``: no tree is deeper.  Features that ``df`` lacks, or that are NULL or NaN, count as missing.
    """
    names = _numbers(df)
    known = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    place = F.array_position(known, F.col("feature")).cast("int") - 1
    column = F.struct("position", place.alias("at"), "fill")
    seen = inputs.groupBy(key).agg(F.sort_array(F.collect_list(column)).alias("_own_inputs"))
    tree = F.struct("tree", "weight", "feature", "threshold", "left", "right", "value", F.lit(depth).alias("depth"))
    model = trees.groupBy(key).agg(F.sort_array(F.collect_list(tree)).alias("_own_trees")).join(seen, key)

    model = model.withColumnRenamed(key, "_own_model")
    missing = F.lit(None).cast("double")
    values = F.array(*[F.nanvl(F.col(n).cast("double"), missing) for n in names]) if names else F.array().cast("array<double>")
    features = F.transform(
        "_own_inputs", lambda c: F.coalesce(F.when(c["at"] >= 0, F.get(F.col("_own_values"), c["at"])), c["fill"])
    )
    joined = df.withColumn("_own_values", values).join(model, F.col(key) == F.col("_own_model"), "left").withColumn("_own_features", features)
    total = F.aggregate("_own_trees", F.lit(0.0), lambda sum_, t: sum_ + t["weight"] * _leaf(t, F.col("_own_features")))
    return joined.select(*[F.col(c) for c in df.columns if c != out], total.alias(out))


def tree_scorer(trees: DataFrame, inputs: DataFrame, depth: int = 5) -> Callable[[DataFrame], DataFrame]:
    """A scorer for forecasts of all regions."""
    return lambda df: score_trees(df, trees, inputs, depth)
