import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerolith.functions import airquality, angles, geo, text, times
from aerolith.operators import clean, quality
from aerolith.operators.metrics import regression_metrics


def circular(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return df.agg(angles.circular_mean(F.col("x")), angles.circular_std(F.col("x"))).first()


def test_circular_edges(spark):
    mean, std = circular(spark, [350.0, 10.0])
    assert round(mean, 6) % 360 == 0
    assert std == pytest.approx(math.sqrt(-2 * math.log(math.cos(math.radians(10)))))
    mean, std = circular(spark, [37.0] * 5)
    assert mean == pytest.approx(37) and std == pytest.approx(0, abs=1e-7) and math.copysign(1, std) > 0
    assert circular(spark, [0.0, 180.0])[1] > 8
    assert tuple(circular(spark, [None, float("nan")])) == (None, None)
    mean, _ = circular(spark, [None, float("nan"), 90.0])
    assert mean == pytest.approx(90)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 120), min_size=2, max_size=8), st.integers(0, 359))
def test_circular_rotation(spark, values, turn):
    mean, std = circular(spark, [float(v) for v in values])
    turned_mean, turned_std = circular(spark, [float((v + turn) % 360) for v in values])
    gap = (turned_mean - mean - turn) % 360
    assert min(gap, 360 - gap) < 1e-6
    assert turned_std == pytest.approx(std, abs=1e-6)


def test_index_table(spark):
    points = {0: 0, 12: 50, 13: 52, 35: 99, 36: 101, 55: 149, 56: 150, 99: 173, 149: 199, 150: 200, 199: 249}
    rows = [(float(x) + 0.9, y) for x, y in points.items()] + [(-1.0, None), (-0.1, None), (200.0, None), (None, None)]
    df = spark.createDataFrame(rows, "x double, y int")
    for r in df.select("x", "y", airquality.concentration_to_index(F.col("x")).alias("z")).collect():
        assert r["y"] == r["z"], r
    whole = spark.range(200).select(airquality.concentration_to_index(F.col("id").cast("double")).alias("z"))
    values = [r["z"] for r in whole.orderBy("z").collect()]
    assert len(values) == 200 and None not in values and values[0] == 0 and values[-1] == 249
    with pytest.raises(Exception, match="outside the index table"):
        df.select(airquality.concentration_to_index(F.col("x"), strict=True)).collect()


def test_bands(spark):
    df = spark.createDataFrame([(0,), (49,), (50,), (149,), (199,), (200,), (300,), (None,)], "i int")
    got = [r[0] for r in df.select(airquality.index_band(F.col("i"))).collect()]
    assert got == [
        "Good", "Good", "Moderate", "Unhealthy for Some", "Unhealthy", "Very Unhealthy", "Hazardous", None,
    ]


def test_nearest_region(spark):
    df = spark.createDataFrame([(1.35, 103.94), (1.42, 103.82), (None, None), (float("nan"), 103.8)], "a double, o double")
    strict = geo.nearest_region(F.col("a"), F.col("o"))
    lenient = geo.nearest_region(F.col("a"), F.col("o"), unmatched="first")
    got = [tuple(r) for r in df.select(strict, lenient).collect()]
    assert got == [("east", "east"), ("north", "north"), (None, "central"), (None, "central")]
    tie = geo.nearest_region(F.lit(0.0), F.lit(0.0), centroids=[("b", 1.0, 0.0), ("a", -1.0, 0.0)])
    assert spark.range(1).select(tie).first()[0] == "b"
    with pytest.raises(ValueError):
        geo.nearest_region(F.col("a"), F.col("o"), centroids=[])
    # More centroids than are compared inline: the same rule, ties and missing coordinates included.
    rng = random.Random(1)
    many = [(f"c{i}", rng.uniform(1.2, 1.5), rng.uniform(103.6, 104.0)) for i in range(300)] + [("copy", 1.35, 103.94), ("twin", 1.35, 103.94)]
    places = [(rng.uniform(1.2, 1.5), rng.uniform(103.6, 104.0)) for _ in range(50)] + [(1.35, 103.94)]
    df = spark.createDataFrame([*places, (None, 103.8), (float("nan"), 103.8)], "a double, o double")
    column = geo.nearest_region(F.col("a"), F.col("o"), centroids=many)
    want = [min(many, key=lambda c, p=p: (p[0] - c[1]) ** 2 + (p[1] - c[2]) ** 2)[0] for p in places]
    assert [r[0] for r in df.select(column).collect()] == [*want, None, None] and want[-1] == "copy"
    lenient = geo.nearest_region(F.col("a"), F.col("o"), centroids=many, unmatched="first")
    assert df.select(lenient).collect()[-1][0] == "c0"


def test_time_rules(spark):
    df = spark.createDataFrame([("2025-01-01T00:30:00+08:00",), ("nonsense",)], "t string")
    ts = times.parse_instant(F.col("t"))
    local, missing = df.select(times.local_day(ts, "Asia/Singapore"), times.local_day(ts, "UTC")).collect()
    assert tuple(local) == (dt.date(2025, 1, 1), dt.date(2024, 12, 31)) and tuple(missing) == (None, None)
    half_hour = df.select(times.hour_start(ts, "Asia/Kolkata")).first()[0]
    assert half_hour == dt.datetime(2024, 12, 31, 22)
    saturday = spark.sql("SELECT TIMESTAMP_NTZ'2025-10-04 13:00:00' AS t").select(*times.calendar_columns(F.col("t"), True))
    assert tuple(saturday.first()) == (13, 5, 4, 10, 2025, True)
    empty = spark.range(1).select(times.regular_times(F.lit(10), F.lit(10), F.lit(5)), times.regular_times(F.lit(0), F.lit(11), F.lit(5)))
    assert tuple(empty.first()) == ([], [0, 5])


def test_direction_bounds_and_numbers(spark):
    df = spark.createDataFrame([("-0.1",), ("0",), ("360",), ("360.1",), ("n/a",), ("NaN",), (None,)], "d string")
    kept = clean.valid_directions(clean.coerce_numeric(df, "d"), "d")
    assert sorted(r[0] for r in kept.collect()) == [0.0, 360.0]
    assert tuple(clean.validity_report(df, "d").first()) == (7, 3, 2, 2)
    assert df.select(text.safe_name(F.lit("A b/c\\d"))).first()[0] == "A_b_c_d"


def test_rename_swaps_and_alignment(spark):
    df = spark.createDataFrame([(1, 2, "x")], "a int, b int, c string")
    assert clean.rename(df, {"a": "b", "b": "a"}).first().asDict() == {"b": 1, "a": 2, "c": "x"}
    assert clean.align_features(df, ["b", "zz", "a"]).columns == ["b", "zz", "a"]
    assert clean.numeric_columns(df, ["a"]) == ["b"]
    described = clean.describe_columns(df, {"a": "first", "nope": "x"})
    assert described.schema["a"].metadata["comment"] == "first"


def test_quality_gates(spark):
    df = spark.createDataFrame([(1, 5.0), (1, None), (2, -3.0), (2, 4.0)], "sensor_id int, pm25 double")
    assert quality.check_minima(df, [("pm25", -0.1, 500.0)]).first()["passed"] is False
    with pytest.raises(quality.QualityError, match="pm25"):
        quality.require_minima(df, [("pm25", -0.1, 500.0)])
    with pytest.raises(quality.QualityError, match="different"):
        quality.require_null_gate(df, "sensor_id", "pm25")
    assert quality.require_minima(df, [("pm25", -3.1, 500.0)]) is df


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0), (None, 1.0)], "pm25 double, predicted_pm25 double")
    row = regression_metrics(df).first()
    assert row["n"] == 3 and row["mse"] == pytest.approx(1.25 / 3) and row["r2"] == pytest.approx(1 - 1.25 / 2)
    flat = spark.createDataFrame([(1.0, 1.5), (1.0, 2.0)], "pm25 double, predicted_pm25 double")
    assert regression_metrics(flat).first()["r2"] is None
