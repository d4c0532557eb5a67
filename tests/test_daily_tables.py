"""The daily tables of the training view come from one pass over the orders."""

import datetime as dt

from pyspark.sql import functions as F

from aerolith.registry import adapters as a

DAYS = [dt.datetime(2000, 1, d) for d in range(1, 5)]


def _tables(spark, sf):
    """Orders without lines, twice, without customer, day or key; lines without order or key."""
    write = lambda name, rows, kinds: spark.createDataFrame(rows, kinds).write.parquet(f"{sf}/{name}.parquet")
    write("region", [(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    write("nation", [(0, 0), (1, 1)], "n_nationkey int, n_regionkey int")
    write("customer", [(1, 0), (2, 1), (3, None)], "c_custkey bigint, c_nationkey int")
    orders = [
        (1, 1, DAYS[0], 100.0), (2, 1, DAYS[0], 300.0), (3, 2, DAYS[0], 50.0), (3, 2, DAYS[0], 50.0), (4, 1, DAYS[1], 70.0),
        (None, 1, DAYS[2], 80.0), (5, 1, None, 90.0), (6, 3, DAYS[3], 10.0), (7, None, DAYS[3], 10.0), (8, 2, DAYS[3], None),
    ]
    write("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, o_totalprice double")
    lines = [(1, 5.0, 0.1, 0.02), (1, 7.0, 0.04, None), (2, None, 0.05, 0.01), (3, 2.0, 0.03, 0.08), (5, 1.0, 0.0, 0.0),
             (8, 4.0, 0.02, 0.04), (9, 9.0, 0.09, 0.09), (None, 8.0, 0.08, 0.08)]
    write("lineitem", lines, "l_orderkey bigint, l_quantity double, l_discount double, l_tax double")


def test_one_pass_gives_both_rollups(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    read, table = [], a.table
    monkeypatch.setattr(a, "table", lambda spark, sf, name: read.append(name) or table(spark, sf, name))
    tables = a.daily_tables(spark, str(tmp_path))
    days = {(r.region, r.timestamp): r.pm25 for r in tables["pm25"].collect()}
    assert sorted(read) == ["customer", "lineitem", "nation", "orders", "region"]

    assert days == {
        ("ASIA", DAYS[0]): 200 / 9973, ("EUROPE", DAYS[0]): 50 / 9973, ("ASIA", DAYS[1]): 70 / 9973,
        ("ASIA", DAYS[2]): 80 / 9973, ("ASIA", None): 90 / 9973, ("EUROPE", DAYS[3]): None,
    }
    apart = a.weather(spark, str(tmp_path)).drop("precipitation_sum")
    together = tables["direction"].join(tables["speed"].withColumnsRenamed({"region": "r", "timestamp": "t"}),
        F.col("region").eqNullSafe(F.col("r")) & F.col("timestamp").eqNullSafe(F.col("t")))
    together = together.join(tables["temperature"].withColumnsRenamed({"region": "q", "timestamp": "s"}),
        F.col("region").eqNullSafe(F.col("q")) & F.col("timestamp").eqNullSafe(F.col("s")))
    found = together.select(*apart.columns).collect()
    key = lambda r: (r.region, str(r.timestamp))
    assert sorted(a.rounded(together.select(*apart.columns)).collect(), key=key) == sorted(a.rounded(apart).collect(), key=key)
    assert {(r.region, r.timestamp) for r in found} == {("ASIA", DAYS[0]), ("EUROPE", DAYS[0]), ("ASIA", None), ("EUROPE", DAYS[3])}
