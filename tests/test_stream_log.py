import datetime as dt
import os


from aerolith.streaming.log import append_to_log, close_hours, correct_hours, read_hours, read_log, watermark

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id int, region string, timestamp timestamp, value double"
SETTINGS = {"key": ["id"], "value": "value", "name": "v"}


def land(spark, path, rows):
    data = [(i, r, None if m is None else T0 + dt.timedelta(minutes=m), v) for i, r, m, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp, batches, landing="landing"):
    root, source = f"{tmp}/log", f"{tmp}/{landing}"
    schema = spark.createDataFrame([], SCHEMA).schema
    for rows in batches:
        land(spark, source, rows)
        stream = spark.readStream.schema(schema).parquet(source)
        append_to_log(stream, root, f"{tmp}/c-log").awaitTermination()
        close_hours(spark, root, f"{tmp}/c-close", schema, **SETTINGS).awaitTermination()
    return root, schema


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")}


def test_hours_close_late_readings_correct_them_and_nothing_is_rewritten(spark, tmp_path):
    first = [(1, "a", 10, 1.0), (2, "a", 50, 3.0), (2, "a", 50, 3.0), (3, "a", 70, 5.0), (4, None, 20, 9.0)]
    second = [(5, "a", 250, 7.0), (2, "a", 50, 3.0)]  # id 2 once more, within the delay of the state
    root, schema = run(spark, tmp_path, [first, second])
    hours = {(r.region, r.timestamp.hour): (r.v_avg, r.reading_count) for r in read_hours(spark, root).collect()}
    assert hours == {("a", 0): (2.0, 2), ("a", 1): (5.0, 1), (None, 0): (9.0, 1)}
    before = files(root)

    third = [(6, "a", 30, 5.0), (7, "b", 45, 4.0), (3, "a", 70, 5.0), (8, "a", 140, 6.0), (9, "a", None, 1.0)]
    run(spark, tmp_path, [third])
    assert read_log(spark, root, schema, ["id"], ["late"]).count() == 4  # 140 minutes are within two hours of 250
    assert correct_hours(spark, root, schema, **SETTINGS) == 0
    hours = {(r.region, r.timestamp.hour): (r.v_avg, r.reading_count) for r in read_hours(spark, root).collect()}
    assert hours[("a", 0)] == (3.0, 3) and hours[("b", 0)] == (4.0, 1) and hours[("a", 1)] == (5.0, 1)
    assert correct_hours(spark, root, schema, **SETTINGS) == 1 and read_hours(spark, root).count() == 4
    after = files(root)
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)
    assert read_log(spark, root, schema, ["id"]).count() == 9


def test_an_hour_that_is_open_is_corrected_after_it_closed(spark, tmp_path):
    root, schema = run(spark, tmp_path, [[(1, "a", 0, 1.0), (2, "a", 200, 1.0)], [(3, "a", 75, 8.0)]])
    assert watermark(spark, root).astimezone(dt.timezone.utc) == T0 + dt.timedelta(minutes=80)
    assert read_log(spark, root, schema, ["id"], ["late"]).count() == 1
    assert correct_hours(spark, root, schema, **SETTINGS) is None  # hour 1 ends after the watermark
    run(spark, tmp_path, [[(4, "a", 90, 2.0), (5, "a", 400, 1.0)]])
    assert correct_hours(spark, root, schema, **SETTINGS) == 0
    hours = {r.timestamp.hour: (r.v_avg, r.reading_count) for r in read_hours(spark, root).collect()}
    assert hours[1] == (5.0, 2) and hours[0] == (1.0, 1) and hours[3] == (1.0, 1)


def test_without_any_reading(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    assert watermark(spark, str(tmp_path)) is None
    assert read_log(spark, str(tmp_path), schema, ["id"]).count() == 0
    assert correct_hours(spark, str(tmp_path), schema, **SETTINGS) is None
