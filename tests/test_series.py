import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pluvio.operators import series
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def slot(i):
    return T0 + dt.timedelta(minutes=15 * i)


def test_counter_diff_equals_per_device_lag(spark):
    random.seed(7)
    data = []
    for dev in ("a", "b", "c"):
        for i in sorted(random.sample(range(0, 96 * 6), 150)):  # gaps across days
            v = None if random.random() < 0.1 else round(random.uniform(0, 50), 2)
            data.append((dev, slot(i), v))
    df = spark.createDataFrame(data, "device string, slot timestamp_ntz, value double")
    got = series.counter_diff(df, keep_raw="raw")
    w = Window.partitionBy("device").orderBy("slot")
    ref = df.withColumn("raw", F.col("value") - F.lag("value").over(w)).withColumn(
        "interval", F.when(F.col("raw") < 0, 0.0).otherwise(F.col("raw")))
    assert rows(got, "device", "slot", "interval", "raw") == rows(ref, "device", "slot", "interval", "raw")


def test_lag_spans_empty_days(spark):
    df = spark.createDataFrame([("a", slot(0), 1.0), ("a", slot(96 * 3 + 5), 4.0)],
                               "device string, slot timestamp_ntz, value double")
    got = rows(series.lag_in_series(df, ["device"], "slot", ["value"]), "slot", "prev_value")
    assert got == [(slot(0), None), (slot(96 * 3 + 5), 1.0)]


def test_grid_is_dense_between_global_bounds(spark):
    df = spark.createDataFrame([("a", slot(3), 1.0), ("b", slot(200), 2.0)],
                               "device string, slot timestamp_ntz, value double")
    g = series.densify(df)
    assert g.count() == 2 * 198
    assert g.filter(F.col("value").isNotNull()).count() == 2
    assert g.groupBy("device").agg(F.min("slot"), F.max("slot")).collect()[0][1] == slot(3)


def test_rolling_full_window_only(spark):
    vals = [None] * 12 + [1.0] * 20
    df = spark.createDataFrame([("a", slot(i), v) for i, v in enumerate(vals)],
                               "device string, slot timestamp_ntz, interval double")
    r = {x["slot"]: x["s"] for x in series.rolling_full_window_sum(df, "interval", "s").collect()}
    assert all(r[slot(i)] is None for i in range(11))
    assert r[slot(11)] == 0.0            # full window of nulls -> 0
    assert r[slot(12)] == 1.0 and r[slot(30)] == 12.0


def test_rolling_restarts_each_day(spark):
    df = spark.createDataFrame([("a", slot(i), 1.0) for i in range(90, 110)],
                               "device string, slot timestamp_ntz, interval double")
    r = {x["slot"]: x["s"] for x in series.rolling_full_window_sum(df, "interval", "s").collect()}
    assert r[slot(95)] is None and r[slot(96)] is None and r[slot(107)] == 12.0


def test_drop_last_day_and_daily_null_rule(spark):
    df = spark.createDataFrame([("a", slot(0), None, None), ("a", slot(1), None, None),
                                ("b", slot(0), 2.0, None), ("b", slot(96), 1.0, 5.0)],
                               "device string, slot timestamp_ntz, interval double, max_3_hour double")
    d = series.drop_last_day(df)
    assert d.count() == 3
    out = {r["device"]: r for r in series.daily_rain(series.with_day(d)).collect()}
    assert out["a"]["interval"] is None and out["a"]["max_3_hr_interval"] is None
    assert out["b"]["interval"] == 2.0


def test_dense_grid_lag_equals_general_lag(spark):
    random.seed(5)
    data = [(dev, slot(i), None if random.random() < 0.4 else float(i))
            for dev in ("a", "b") for i in range(7, 96 * 4 - 3)]
    df = spark.createDataFrame(data, "device string, slot timestamp_ntz, value double")
    a = rows(series.lag_on_grid(df, ["device"], "slot", ["value"], 15), "device", "slot", "prev_value")
    b = rows(series.lag_in_series(df, ["device"], "slot", ["value"]), "device", "slot", "prev_value")
    assert a == b


def test_flat_counter_has_no_rain_and_no_reset(spark):
    """The same readings in another order give no difference, and no flag."""
    from pluvio.operators import series
    vals = [0.1, 0.2, 0.3]
    rows_ = [("g", dt.datetime(2020, 1, 1, 0, 15 * s, i), v) for s, order in enumerate((vals, vals[::-1], [0.3, 0.1, 0.2]))
             for i, v in enumerate(order)]
    df = spark.createDataFrame(rows_, "device string, ts timestamp_ntz, value double").coalesce(1)
    d = series.counter_diff(series.bucket_mean(df), clamp=False)
    assert [r["interval"] for r in d.orderBy("slot").collect()] == [None, 0.0, 0.0]


def test_slot_table_is_a_hash_aggregation_and_names_null_devices(spark):
    import pytest

    from pluvio.plans import pipelines as pl
    df = spark.createDataFrame([(None, dt.datetime(2020, 1, 1), 5.0), ("a", dt.datetime(2020, 1, 1), 6.0), ("a", None, 7.0)],
                               "device string, ts timestamp_ntz, value double")
    t = pl.slot_table(df, pl.GaugeRules())
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert sorted(r["device"] for r in t.collect()) == ["a", "unknown"]
    assert tuple(pl.rejected_readings(df).first()) == (3, 1)
    with pytest.raises(ValueError):
        pl.GaugeRules(minutes=7)


def test_coverage_of_two_years(spark):
    from pluvio.operators import coverage
    days = [dt.date(2020 + y, 1, 1) + dt.timedelta(i) for y in range(2) for i in range(31)]
    bins = spark.createDataFrame([(d, "g", "yes", b) for d in days for b in range(3)], "date date, device string, available string, b int")
    got = coverage.month_coverage(bins).orderBy("year").collect()
    assert [(r["year"], r["count"], r["percent"]) for r in got] == [(2020, 31, 100.0), (2021, 31, 100.0)]
