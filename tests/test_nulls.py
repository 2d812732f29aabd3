import datetime as dt

from pyspark.sql import functions as F

from pluvio.functions.nulls import (finite_or_null, r_if_else, round_half, row_total, strict_sum, sum_keep_null,
                                    sum_or_zero, zero_fill)

S = "k string, v double"


def test_four_sum_rules(spark):
    df = spark.createDataFrame([("all_null", None), ("all_null", None), ("mixed", 1.0), ("mixed", None),
                                ("mixed", 2.5), ("full", 1.0), ("full", 2.0)], S)
    out = {r["k"]: r for r in df.groupBy("k").agg(
        sum_keep_null("v").alias("keep"), sum_or_zero("v").alias("zero"),
        strict_sum("v").alias("strict"), F.avg("v").alias("mean")).collect()}
    assert out["all_null"]["keep"] is None and out["all_null"]["zero"] == 0.0
    assert out["all_null"]["strict"] is None and out["all_null"]["mean"] is None
    assert out["mixed"]["keep"] == 3.5 and out["mixed"]["zero"] == 3.5 and out["mixed"]["strict"] is None
    assert out["full"]["strict"] == 3.0


def test_row_total_null_only_when_all_null(spark):
    df = spark.createDataFrame([(None, None, None), (1.0, None, 2.0), (None, 0.0, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(row_total(["a", "b", "c"])).collect()]
    assert got == [None, 3.0, 0.0]


def test_if_else_keeps_null_condition(spark):
    df = spark.createDataFrame([(None,), (5.0,), (500.0,)], "v double")
    got = [r[0] for r in df.select(r_if_else(F.col("v") > 100, F.lit("hi"), F.lit("lo"))).collect()]
    assert got == [None, "lo", "hi"]


def test_round_half_on_scaled_value(spark):
    df = spark.createDataFrame([(62.13875,), (2.675,), (-2.5,), (0.125,)], "v double")
    got = [r[0] for r in df.select(round_half("v", 4)).collect()]
    assert got[0] == 62.1388
    assert [r[0] for r in df.select(round_half("v", 2)).collect()][1] == 2.68
    assert [r[0] for r in df.select(round_half("v", 0)).collect()][2] == -3.0


def test_zero_fill_numeric_only(spark):
    df = spark.createDataFrame([(None, None, dt.date(2024, 1, 1))], "a double, s string, d date")
    r = zero_fill(df).collect()[0]
    assert r["a"] == 0.0 and r["s"] is None


def test_infinities_and_nan_become_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.5,), (None,)], "v double")
    assert [r[0] for r in df.select(finite_or_null("v")).collect()] == [None, None, None, 1.5, None]
