import datetime as dt

from pyspark.sql import functions as F

from pluvio.functions.dates import (ampm_timestamp, anchored_bin, any_date, day_month_ambiguous,
                                    parse_date, parse_timestamp)


def test_ambiguous_day_month(spark):
    df = spark.createDataFrame([("25/06/2019",), ("06/25/2019",), ("05/06/2019",), ("5/6/2019",),
                                ("31/04/2019",), ("Date",), ("13/1/",)], "t string")
    got = [r[0] for r in df.select(day_month_ambiguous("t", 2020)).collect()]
    assert got[0] == dt.date(2020, 6, 25)       # first field > 12 -> day first
    assert got[1] == dt.date(2020, 6, 25)       # month first
    assert got[2] == dt.date(2020, 5, 6)        # <= 12 -> read month first: day 06, month 05
    assert got[3] is None                       # one-digit first field '5/' is not a number
    assert got[4] is None                       # 31 April does not exist
    assert got[5] is None
    assert got[6] == dt.date(2020, 1, 13)       # slash stripped from the month


def test_parsers_return_null_on_bad_text(spark):
    df = spark.createDataFrame([("2024-01-05 03:07:09", "5/1/2024 3:07", "x")], "a string, b string, c string")
    r = df.select(parse_timestamp("a", "yyyy-MM-dd HH:mm:ss").alias("a"),
                  parse_timestamp("b", "d/M/yyyy H:mm").alias("b"),
                  parse_timestamp("c", "d/M/yyyy H:mm").alias("c"),
                  parse_date("b", "d/M/yyyy H:mm").alias("d")).collect()[0]
    assert r["a"] == dt.datetime(2024, 1, 5, 3, 7, 9) and r["b"] == dt.datetime(2024, 1, 5, 3, 7)
    assert r["c"] is None and r["d"] == dt.date(2024, 1, 5)


def test_any_date_formats(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024/01/06",), ("7/1/2024",), ("junk",)], "t string")
    assert [r[0] for r in df.select(any_date("t")).collect()] == [
        dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), None]


def test_ampm_suffix_and_shift(spark):
    df = spark.createDataFrame([("1/5/24", "3:00 p"), ("1/5/24", "12:30 a")], "d string, t string")
    got = [r[0] for r in df.select(ampm_timestamp("d", "t", 12)).collect()]
    assert got == [dt.datetime(2024, 1, 6, 3, 0), dt.datetime(2024, 1, 5, 12, 30)]


def test_anchored_bins_cross_midnight(spark):
    ts = [dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 18, 14), dt.datetime(2024, 1, 1, 18, 15),
          dt.datetime(2024, 1, 2, 1, 0)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    anchor = F.lit(dt.datetime(2024, 1, 1, 10, 15)).cast("timestamp_ntz")
    got = [r[0] for r in df.select(anchored_bin("t", anchor, 480)).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10, 15), dt.datetime(2024, 1, 1, 10, 15),
                   dt.datetime(2024, 1, 1, 18, 15), dt.datetime(2024, 1, 1, 18, 15)]


def test_wall_clock_kept_in_any_session_zone(spark):
    from pluvio.functions.dates import ntz_literal
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("bad",)], "s string")
        got = [r[0] for r in df.select(parse_timestamp("s", "yyyy-MM-dd HH:mm:ss")).collect()]
        assert got == [dt.datetime(2024, 3, 10, 2, 30), None]
        lit = spark.range(1).select(ntz_literal(dt.datetime(2024, 1, 1))).collect()[0][0]
        assert lit == dt.datetime(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
