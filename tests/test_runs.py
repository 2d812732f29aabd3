import datetime as dt
import random

from pyspark.sql import functions as F

from pluvio.functions.dates import ntz_literal
from pluvio.operators import coverage, runs, series
from pluvio.plans import pipelines as pl
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def at(i, minutes=15):
    return T0 + dt.timedelta(minutes=minutes * i)


def _series(spark, present, minutes=15):
    return spark.createDataFrame([(d, at(i, minutes), v) for d, i, v in present], "device string, slot timestamp_ntz, value double")


def test_runs_and_gaps(spark):
    s = _series(spark, [("a", i, 1.0) for i in (0, 1, 2, 5, 94, 95, 96, 97, 300)] + [("b", 7, None), ("b", 8, 2.0)])
    by_day = runs.day_runs(s, value="value")
    assert rows(by_day, "device", "first", "last", "slots") == [
        ("a", at(0), at(2), 3), ("a", at(5), at(5), 1), ("a", at(94), at(95), 2), ("a", at(96), at(97), 2), ("a", at(300), at(300), 1), ("b", at(8), at(8), 1)]
    whole = runs.series_runs(by_day)
    assert rows(whole, "device", "first", "last", "slots") == [
        ("a", at(0), at(2), 3), ("a", at(5), at(5), 1), ("a", at(94), at(97), 4), ("a", at(300), at(300), 1), ("b", at(8), at(8), 1)]
    assert rows(runs.gaps(whole), "device", "gap_first", "gap_last", "slots") == [
        ("a", at(3), at(4), 2), ("a", at(6), at(93), 88), ("a", at(98), at(299), 202)]


def test_coverage_from_runs_equals_coverage_of_the_grid(spark):
    rng = random.Random(9)
    for minutes in (15, 30, 5):
        day = 1440 // minutes
        first = rng.randint(0, day - 1)
        present = [(d, i, None if rng.random() < 0.2 else 1.0) for d in "ab" for i in range(first, day * 40)
                   if (i // (day // 3)) % 4 in ((0, 1) if d == "a" else (3,)) and rng.random() < 0.8]
        present += [("a", first, 1.0), ("b", day * 41 + 3, 1.0), ("c", first + 4, None)]
        s = _series(spark, present, minutes).dropDuplicates(["device", "slot"])
        lo, hi = s.agg(F.min("slot"), F.max("slot")).first()
        end = hi.date()
        grid = series.drop_last_day(series.densify(s, minutes=minutes))
        dense = coverage.bin_availability(grid, value="value")
        known = runs.day_runs(s, minutes=minutes, value="value").filter(F.col("date") < F.lit(end))
        devices = s.select("device").distinct()
        counts = runs.bin_counts(known, ntz_literal(lo), minutes=minutes)
        every = runs.all_bins(devices, lo, end, minutes=minutes)
        got = every.join(counts, ["device", "date", "bin_start"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
        assert rows(got, "device", "date", "bin_start", "count") == rows(dense, "device", "date", "bin_start", "count")
        m = runs.month_coverage(runs.usable_days(counts), devices, lo, end)
        cols = ("device", "year", "month_num", "month", "count", "number_of_days", "percent")
        assert rows(m, *cols) == rows(coverage.month_coverage(dense), *cols)
        c = runs.completeness(known, devices, lo, end, minutes=minutes)
        assert rows(c, "device", "total_data", "available_data", "percent") == rows(
            coverage.device_completeness(dense, slot_minutes=minutes), "device", "total_data", "available_data", "percent")


def test_a_century_between_readings(spark):
    ts = [dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 15), dt.datetime(2120, 1, 2)]
    r = spark.createDataFrame([("g", t, float(i)) for i, t in enumerate(ts)], "device string, ts timestamp_ntz, value double")
    inp = pl.Inputs(readings=r)
    assert pl.known_runs(inp).count() == 1
    for t in (pl.device_completeness(inp), pl.month_coverage(inp), pl.reading_gaps(inp)):
        plan = t._jdf.queryExecution().executedPlan().toString()
        assert "_interval_minutes" not in plan and "INTERVAL '00:15' HOUR TO MINUTE)), [" not in plan
    days = (dt.date(2120, 1, 2) - dt.date(2020, 1, 1)).days
    assert rows(pl.device_completeness(inp), "total_data", "available_data") == [(days * 96, 1)]
    assert rows(pl.reading_gaps(inp), "gap_first", "slots") == [(dt.datetime(2020, 1, 1, 0, 30), days * 96 - 2)]
    assert pl.month_coverage(inp).count() == 1201
    assert tuple(pl.reading_counts(inp.ingested(), inp.period).first()) == (3, 0, 1)


def test_completeness_by_slot_length(spark):
    """Half-hour slots, complete: 48 a day, of which the first has no difference."""
    data = [("g", at(i, 30), float(i)) for i in range(48 * 2 + 1)]
    r = spark.createDataFrame(data, "device string, ts timestamp_ntz, value double")
    inp = pl.Inputs(readings=r, rules=pl.GaugeRules(minutes=30))
    got = pl.device_completeness(inp).first()
    assert (got["total_data"], got["available_data"]) == (96, 95)


def test_nothing_before_the_last_day(spark):
    r = spark.createDataFrame([("g", at(i), float(i)) for i in range(5)], "device string, ts timestamp_ntz, value double")
    inp = pl.Inputs(readings=r)
    assert pl.bins(inp).count() == pl.month_coverage(inp).count() == pl.device_completeness(inp).count() == 0
    empty = pl.Inputs(readings=r.limit(0))
    assert pl.bins(empty).count() == pl.month_coverage(empty).count() == pl.device_completeness(empty).count() == pl.reading_gaps(empty).count() == 0
