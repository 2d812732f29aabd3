"""One pass over gauge exports: layout of the scan, one exchange, counts, names."""
import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from pluvio.functions.dates import ANY_DATE_FORMATS, any_date
from pluvio.operators import columns, quality, series
from pluvio.plans import exports, publish
from pluvio.plans import pipelines as pl
from pluvio.sources import readers
from tests.conftest import rows

FILES = {
    "a_reporting.csv": "Time,Device.name,Value\n2020-06-01 00:00:00,South,10\n2020-06-01 00:15:00,South,11\n2020-06-02 00:00:00,12 East,1\n",
    "b_reporting.csv": "Device.name,Value,Time\nSouth,11.0,2020-06-01 00:15:00\nSouth,99,not a time\nSouth,99,not a time\n,5,2020-06-01 00:15:00\n",
    "c_GSB.csv": "Date,12 East,Xeno,,X.3\n02/06/2020 00:00,14,5,,\n2/6/2020 0:15,15,7,,z\n",
}


@pytest.fixture
def folder(tmpdir_path):
    for name, text in FILES.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    return tmpdir_path


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_between_the_scans_and_the_slot_table(spark, folder):
    r = exports.gauge_readings(spark, exports.Layout(gauges=folder))
    plan = _plan(pl.ingest(r, pl.GaugeRules(), pl.EXPORT_ROW))
    assert plan.count("Scan csv") == 3 and len(re.findall(r"\bExchange ", plan)) == 1
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_repeated_rows_names_and_untimed_readings(spark, folder):
    r = exports.gauge_readings(spark, exports.Layout(gauges=folder))
    got = pl.ingest(r, pl.GaugeRules(), pl.EXPORT_ROW)
    assert rows(got.select("device", "slot", "accumulated", "readings")) == sorted([
        ("South", dt.datetime(2020, 6, 1), 10.0, 1), ("South", dt.datetime(2020, 6, 1, 0, 15), 11.0, 1),
        ("unknown", dt.datetime(2020, 6, 1, 0, 15), 5.0, 1), ("South", None, 99.0, 1),
        ("12 East", dt.datetime(2020, 6, 2), 1.0, 1),
        ("x_12_east", dt.datetime(2020, 6, 2), 14.0, 1), ("x_12_east", dt.datetime(2020, 6, 2, 0, 15), 15.0, 1),
        ("xeno", dt.datetime(2020, 6, 2), 5.0, 1), ("xeno", dt.datetime(2020, 6, 2, 0, 15), 7.0, 1)], key=repr)
    counts = pl.reading_counts(got, pl.Period(spine_start="2020-06-02"))
    assert tuple(counts.first()) == (9, 1, 3)


def test_the_published_tables_read_the_gauge_files_once(spark, folder):
    """After the tables are built, no plan reads a gauge file any more."""
    inp = exports.inputs(spark, exports.Layout(gauges=folder), period=pl.Period(spine_start="2020-06-01", spine_end="2020-06-02"))
    out = publish.tables(spark, inp)
    for name, t in out.items():
        assert "_reporting.csv" not in _plan(t) and "Scan csv" not in _plan(t), name


def test_a_device_named_like_the_missing_one_stays_apart(spark):
    t0 = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([(None, t0, 500.0), ("unknown", t0, 10.0), ("unknown_", t0, 1.0)], "device string, ts timestamp_ntz, value double")
    assert rows(pl.slot_table(df, pl.GaugeRules()), "device", "accumulated") == [("unknown", 500.0), ("unknown_", 10.0), ("unknown__", 1.0)]


def test_order_of_readings_plays_no_part(spark):
    rng = random.Random(4)
    data = [(f"g{i % 3}", dt.datetime(2020, 1, 1) + dt.timedelta(seconds=rng.randint(0, 20_000)), rng.uniform(0, 200)) for i in range(3000)]
    def table(seed, parts):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "device string, ts timestamp_ntz, value double").repartition(parts)
        return rows(pl.slot_table(df, pl.GaugeRules()))
    assert table(1, 2) == table(2, 7)


def test_a_large_file_is_split_and_never_held_whole(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "huge_reporting.csv")
    with open(path, "wb") as f:
        f.write(b"Time,Device.name,Value\n")
        f.truncate(3 << 30)  # 3 GiB, mostly a hole
    assert readers.first_lines(spark, [path]) == {path: "Time,Device.name,Value"}
    assert len(readers.files_by_header(spark, tmpdir_path, "*reporting*")) == 1
    os.truncate(path, 0)
    with open(path, "w") as f:
        f.write("Time,Device.name,Value\n")
        f.writelines(f"2020-06-01 00:{i % 60:02}:00,g{i % 5},{i}\n" for i in range(300_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        r = exports.gauge_readings(spark, exports.Layout(gauges=tmpdir_path))
        assert r.rdd.getNumPartitions() > 4
        assert r.count() == 300_000 and r.filter("value is null or ts is null").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    with open(os.path.join(tmpdir_path, "long_reporting.csv"), "w") as f:
        f.write("x" * (readers.HEADER_BYTES + 5) + "\n")
    with pytest.raises(ValueError, match="first line"):
        readers.files_by_header(spark, tmpdir_path, "*reporting*")


def test_many_files_of_few_headers(spark, tmpdir_path):
    heads = ("Time,Device.name,Value", "Value,Time,Device.name", '"Time","Device.name","Value","Note, long"')
    for i in range(1000):
        with open(os.path.join(tmpdir_path, f"f{i}_reporting.csv"), "w") as f:
            t, d, v = f"2020-06-01 00:{i % 60:02}:00", f"g{i}", str(i)
            f.write(heads[i % 3] + "\n" + (f"{t},{d},{v}", f"{v},{t},{d}", f"{t},{d},{v},n")[i % 3] + "\n")
    r = readers.read_folder(spark, tmpdir_path, "*reporting*", multi_line=False)
    assert _plan(r).count("Scan csv") == 3
    assert {(x["device_name"], x["value"]) for x in r.collect()} == {(f"g{i}", str(i)) for i in range(1000)}


def test_names_that_would_clash_are_refused(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, z int, C int")
    with pytest.raises(ValueError, match="a, C"):
        columns.rename(df, {"a": "c"})
    with pytest.raises(ValueError, match="share"):
        columns.rename(df, {"a": "n", "z": "N"})
    assert columns.rename(df, {"a": "C", "C": "a"}).columns == ["C", "z", "a"]
    m = spark.createDataFrame([("a", "z")], "old_name string, new_name string")
    with pytest.raises(ValueError):
        columns.rename_by_table(df, m)


@pytest.mark.parametrize("minutes", [0, 7, 25, 1441])
def test_steps_that_do_not_divide_a_day(spark, minutes):
    s = spark.createDataFrame([("a", dt.datetime(2020, 1, 1), 1.0)], "device string, slot timestamp_ntz, value double")
    for use in (lambda: series.time_grid(s, minutes=minutes), lambda: series.densify(s, minutes=minutes),
                lambda: series.lag_on_grid(s, ["device"], "slot", ["value"], minutes),
                lambda: quality.gap_flag(s, value="value", step_minutes=minutes or 1441), lambda: pl.GaugeRules(minutes=minutes)):
        with pytest.raises(ValueError):
            use()


def test_long_steps(spark):
    s = spark.createDataFrame([("a", dt.datetime(2020, 1, 1, 2), 1.0), ("a", dt.datetime(2020, 1, 2, 22), 1.0)], "device string, slot timestamp_ntz, value double")
    assert series.densify(s, minutes=120).count() == 23


def test_dates_by_shape(spark):
    days = [dt.date(2020, 3, 7), dt.date(1999, 12, 31), dt.date(2024, 2, 29)]
    spelt = [d.strftime(f) for d in days for f in ("%Y-%m-%d", "%Y/%m/%d", "%Y-%m-%d 06:00:00", "%Y/%m/%d 18:30", "%d/%m/%Y",
                                                    "%b %d, %Y", "%d %b %Y", "%Y%m%d")]
    want = [d for d in days for _ in ANY_DATE_FORMATS]
    odd = [" 7/3/2020 ", "Mar 7, 2020", "7 mar 2020", "2020-13-01", "soon", "", None, "20200230", "2020-03", "7.3.2020"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(spelt + odd)], "i int, t string")
    got = [r["d"] for r in df.select("i", any_date("t").alias("d")).orderBy("i").collect()]
    assert got == want + [days[0], days[0], days[0], None, None, None, None, None, None, None]


def test_no_decimal_for_a_satellite_row(spark):
    df = spark.createDataFrame([("2020-01-01", 0.1)], "system_time_start string, precipitation_rate double").select(
        "*", (F.col("precipitation_rate") * 2).alias("twice"))
    partial = [ln for ln in _plan(pl.satellite_daily(df, rate="twice")).splitlines() if "partial_sum" in ln]
    assert partial and not any("decimal" in ln.lower() for ln in partial)
