import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pluvio.plans import pipelines as pl
from pluvio.plans import publish
from pluvio.sinks import writers
from tests.conftest import rows


def _daily(spark, days, v):
    df = spark.createDataFrame([(dt.date(2024, m, d), v) for m, d in days], "date date, v double")
    return writers.with_month(df)


def test_a_run_that_fails_leaves_the_last_manifest(spark, tmpdir_path):
    days = [(1, 5), (2, 5)]
    writers.publish({"daily": _daily(spark, days, 1.0), "side": spark.range(3)}, tmpdir_path, "r1", {"daily": ["month"]})
    before = writers.manifest(spark, tmpdir_path)
    broken = spark.range(4).select(F.raise_error(F.lit("half-way")).cast("long").alias("id"))
    with pytest.raises(Exception, match="half-way"):
        writers.publish({"daily": _daily(spark, days, 2.0), "side": broken}, tmpdir_path, "r2", {"daily": ["month"]})
    assert writers.manifest(spark, tmpdir_path) == before
    assert rows(writers.read_published(spark, tmpdir_path, "daily"), "v") == [(1.0,), (1.0,)]
    writers.publish({"daily": _daily(spark, days, 3.0)}, tmpdir_path, "r1", {"daily": ["month"]})
    assert rows(writers.read_published(spark, tmpdir_path, "daily"), "v") == [(3.0,), (3.0,)]
    assert writers.read_published(spark, tmpdir_path, "side").count() == 3  # of the earlier run


def _files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(base) for f in fs if f.endswith(".parquet")}


def test_one_month_anew(spark, tmpdir_path):
    paths = writers.publish({"daily": _daily(spark, [(1, 5), (2, 5), (2, 6), (3, 5)], 1.0)}, tmpdir_path, "r1", {"daily": ["month"]})
    before = _files(paths["daily"])
    writers.publish_partitions(_daily(spark, [(2, 6), (4, 1)], 9.0), tmpdir_path, "r2", "daily", ["month"])
    assert _files(paths["daily"]) == before
    got = rows(writers.read_published(spark, tmpdir_path, "daily"), "date", "v", "month")
    assert got == [(dt.date(2024, 1, 5), 1.0, "2024-01"), (dt.date(2024, 2, 6), 9.0, "2024-02"), (dt.date(2024, 3, 5), 1.0, "2024-03"),
                   (dt.date(2024, 4, 1), 9.0, "2024-04")]


def test_nothing_published(spark, tmpdir_path):
    assert writers.manifest(spark, tmpdir_path) == []
    with pytest.raises(FileNotFoundError):
        writers.read_published(spark, tmpdir_path, "daily")


def test_more_gauges_than_columns_come_in_groups(spark, tmpdir_path):
    n = 1001
    r = spark.range(n * 4).select(
        F.concat(F.lit("g"), F.lpad((F.col("id") % n).cast("string"), 4, "0")).alias("device"),
        (F.lit("2024-01-01 23:15:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.floor(F.col("id") / n) * 15).cast("int"))).alias("ts"),
        F.col("id").cast("double").alias("value"))
    inp = pl.Inputs(readings=r, period=pl.Period(spine_start="2024-01-01", spine_end="2024-01-01"))
    out = publish.tables(spark, inp)
    assert out["gauges_subhourly"].columns == ["date_time"]
    names = ("gauges_subhourly_0000", "gauges_subhourly_0001", "hydro_incident_daily_0000", "hydro_incident_daily_0001")
    assert [len(out[n].columns) for n in names] == [3001, 4, 2001, 3]
    small = {n: out[n].select(out[n].columns[0], *[c for c in out[n].columns if c.endswith(("_g0007", "_g1000"))]) for n in names}
    writers.publish(small, tmpdir_path, "r", about={n: publish.group_key(n, t) for n, t in out.items()})
    about = {e["name"]: e["about"] for e in writers.manifest(spark, tmpdir_path)}
    assert about["gauges_subhourly_0001"] == '{"of": "gauges_subhourly", "key": "date_time"}'
    got = {x["date_time"].minute: x for x in writers.read_published(spark, tmpdir_path, "gauges_subhourly_0001").collect()}
    assert (got[30]["cumulative_rain_g1000"], got[30]["rain_g1000"]) == (1000.0 + n, float(n))
    assert "rain_g0007" in small["gauges_subhourly_0000"].columns
