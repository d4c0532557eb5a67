"""The model queries fit for real, and what they return holds."""

import dataclasses

import oracle
import pytest
from pyspark.sql import functions as F

from aerolith import registry
from aerolith.operators import model as m
from aerolith.operators.trees import input_table, load_tables, score_trees, split_counts, store_tables, tree_table
from aerolith.registry import models
from aerolith.session import work_path

SF = "/root/testdata/sf0.001"
FEW = m.TreeParams(rounds=4, max_depth=4, learning_rate=0.3)


def test_model_properties_equal_the_sql(spark, monkeypatch):
    monkeypatch.setattr(models, "_PARAMS", m.TreeParams(rounds=3))
    ours = models.gbt_model_properties(spark, SF).toPandas()
    theirs = oracle.connect(SF).sql(registry.ORACLES["gbt_model_properties"]).df()
    assert oracle.differences(ours, theirs) is None


def test_queries_change_nothing_of_the_setting_but_the_rounds():
    assert models._PARAMS == m.TreeParams(rounds=models.ROUNDS) and m.TreeParams().rounds == 3000


def test_the_metrics_are_those_of_the_whole_setting(spark, monkeypatch):
    """The query's own fits, of few rounds here, for which it asks with the production setting."""
    asked, whole = [], models.fit_regions

    def short(view, regions, test_start, params):
        asked.append(params)
        return whole(view, regions, test_start, dataclasses.replace(params, rounds=2))

    monkeypatch.setattr(models, "fit_regions", short)
    found = models.gbt_test_metrics(spark, SF).collect()
    assert asked == [m.TreeParams()] and asked[0].rounds == 3000
    assert sorted(r.region for r in found) == sorted(models.REGION_NAMES) and all(r.n > 0 for r in found)


def test_tasks_of_a_round_carry_no_long_lineage(rows, monkeypatch):
    """The booster reads files of vectors, not the plan that made them."""
    seen, whole = [], m.GBTRegressor.fit
    monkeypatch.setattr(m.GBTRegressor, "fit", lambda self, df: seen.append(df) or whole(self, df))
    model = m.fit(rows, ["f0", "f1"], params=m.TreeParams(rounds=1))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and plan.count("\n") <= 2
    assert [type(s).__name__ for s in model.stages] == ["SQLTransformer", "VectorAssembler", "GBTRegressionModel"]


@pytest.fixture(scope="module")
def rows(spark):
    """The label depends on f0, on whether f1 is there, and not on f2."""
    df = spark.range(600).select(
        (F.col("id") * 7 % 31).cast("double").alias("f0"),
        F.when(F.col("id") % 3 != 0, (F.col("id") * 13 % 101).cast("double")).alias("f1"),
        F.when(F.col("id") % 50 == 1, F.lit(float("nan"))).otherwise((F.col("id") % 5).cast("double")).alias("f2"),
        (F.col("id") * 7 % 31 + F.when(F.col("id") % 3 == 0, 100.0).otherwise(0.0)).cast("double").alias("pm25"),
        F.lit("a").alias("region"),
    )
    return m.materialize(df)


@pytest.fixture(scope="module")
def fitted(rows):
    return m.fit(rows, ["f0", "f1", "f2"], params=FEW)


def test_a_split_learns_where_missing_values_go(rows):
    model = m.fit(rows, ["f1"], params=m.TreeParams(rounds=1, max_depth=2, row_fraction=1.0, column_fraction=1.0))
    means = m.score(model, rows).groupBy(F.col("f1").isNull().alias("missing")).agg(
        F.min("predicted_pm25").alias("low"), F.max("predicted_pm25").alias("high")
    )
    found = {r.missing: (r.low, r.high) for r in means.collect()}
    assert found[True][0] > 100 and found[False][1] < 30


def test_copies_of_features(rows, fitted):
    copies = {c.name: c for c in m.copies_of(fitted)}
    assert set(copies) == {"f0__filled", "f1__low", "f1__high", "f2__low", "f2__high"}
    assert copies["f1__low"].fill < 0 and copies["f1__high"].fill > 100 and copies["f0__filled"].feature == "f0"
    assert m.features_of(fitted) == ["f0", "f1", "f2"]
    weights = {r.feature: r.importance for r in m.feature_importance(fitted, rows.sparkSession).collect()}
    assert set(weights) == {"f0", "f1", "f2"} and sum(weights.values()) == pytest.approx(1) and weights["f1"] > 0.5


@pytest.fixture(scope="module")
def stored(spark, rows, fitted):
    root = work_path(spark, "trees")
    for region in ("a", "b"):
        m.save_model(fitted, m.evaluate(m.score(fitted, rows), keys=()), region, root)
        store_tables(fitted, region, root)
    return load_tables(spark, root, ["a", "b"])


def test_tables_score_as_the_model(rows, fitted, stored):
    want = {(r.f0, r.f1, str(r.f2)): r.predicted_pm25 for r in m.score(fitted, rows).collect()}
    got = score_trees(rows, *stored, depth=4)
    assert got.columns == [*rows.columns, "predicted_pm25"]
    for r in got.collect():
        assert r.predicted_pm25 == pytest.approx(want[r.f0, r.f1, str(r.f2)], abs=1e-12)
    lacking = score_trees(rows.drop("f1"), *stored, depth=4).collect()
    without = m.score(fitted, rows.drop("f1")).collect()
    assert sorted(r.predicted_pm25 for r in lacking) == pytest.approx(sorted(r.predicted_pm25 for r in without))


def test_a_thousand_models_in_one_plan_and_keys_without_a_model(spark, rows, fitted, stored):
    trees, inputs = (t.filter("region = 'a'").drop("region") for t in stored)
    keys = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("region"))
    many = [m.materialize(t.join(keys)) for t in (trees, inputs)]
    data = rows.limit(1).drop("region").join(spark.range(1001).select(F.concat(F.lit("k"), "id").alias("region")))
    got = score_trees(data, *many, depth=4)
    found = {r.region: r.predicted_pm25 for r in got.collect()}
    one = m.score(fitted, rows.limit(1)).first().predicted_pm25
    assert found.pop("k1000") is None and len(found) == 1000 and all(v == pytest.approx(one) for v in found.values())
    few = score_trees(data, *stored, depth=4)
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    assert abs(size(got) - size(few)) <= 2


def test_splits_are_those_of_the_description(rows, fitted, stored):
    counts = {(r.region, r.feature): r.splits for r in split_counts(*stored).collect()}
    described = m.described_splits(fitted)
    assert counts == {(region, f): n for region in ("a", "b") for f, n in described.items()} and described["f1"] > 0
    top = split_counts(*stored, top=1).collect()
    assert sorted((r.region, r.splits) for r in top) == [("a", max(described.values())), ("b", max(described.values()))]


def test_tables_of_a_saved_pipeline(spark, fitted):
    path = work_path(spark, "pipeline")
    fitted.write().save(path)
    trees = tree_table(spark, path).collect()
    assert len(trees) == 4 and all(len(t.left) == len(t.value) <= 2**5 - 1 for t in trees)
    assert [t.weight for t in sorted(trees, key=lambda t: t.tree)] == [1.0, 0.3, 0.3, 0.3]
    assert input_table(spark, m.copies_of(fitted)).count() == 5


def test_fits_run_side_by_side(spark):
    view = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("region"),
        F.expr("timestampadd(DAY, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("timestamp"),
        (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 17 * 2.0).alias("pm25"),
    )
    params = m.TreeParams(rounds=2, max_depth=3)
    together, scored = m.fit_regions(view, ["a", "b"], "2024-12-01", params)
    alone, again = m.fit_regions(view, ["a", "b"], "2024-12-01", params, at_once=1)
    assert [together[r].stages[-1].toDebugString.split("\n", 1)[1] for r in "ab"] == [
        alone[r].stages[-1].toDebugString.split("\n", 1)[1] for r in "ab"
    ]
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, again.collect())) and scored.count() > 0
