import datetime as dt
import os


from pluvio.sinks import writers
from pluvio.sources import readers
from tests.conftest import rows


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_read_delimited_null_tokens(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "a.csv")
    _write(p, "Date,Rainfall (mm),X.1\n01/02,NA,\n02/02, ,z\n03/02,T,\n")
    df = readers.read_delimited(spark, p)
    assert df.columns == ["date", "rainfall_mm", "x_1"]
    assert rows(df) == [("01/02", None, None), ("02/02", None, "z"), ("03/02", "T", None)]


def test_read_folder_by_pattern_union_by_name(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "jan_reporting.csv"), "Time,Device.name,Value\n2020-01-01 00:00:00,g1,1\n")
    _write(os.path.join(tmpdir_path, "feb_reporting.csv"), "Device.name,Value,Time,Extra\ng2,2,2020-02-01 00:00:00,e\n")
    _write(os.path.join(tmpdir_path, "other_GSB.csv"), "Date,g3\n01/03/2020 00:00,3\n")
    df = readers.read_folder(spark, tmpdir_path, "*reporting*")
    assert sorted(df.columns) == ["device_name", "extra", "time", "value"]
    assert rows(df, "device_name", "value", "extra") == [("g1", "1", None), ("g2", "2", "e")]


def test_two_line_header(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "station.txt")
    _write(p, "\t\tTemp\tHi\n Date\tTime\tOut\tTemp\n6/1/20\t12:00 a\t25.1\t---\n6/1/20\t1:00 a\t25.3\t26.0\n")
    df = readers.read_two_line_header(spark, p)
    assert df.columns == ["date", "time", "temp_out", "hi_temp"]
    assert df.count() == 2


def test_publish_and_csv(spark, tmpdir_path):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4), 1.5)],
                               "date date, ts timestamp_ntz, v double")
    paths = writers.publish({"daily": writers.with_month(df)}, tmpdir_path, "2024-02-01", {"daily": ["month"]})
    back = spark.read.parquet(paths["daily"])
    assert back.count() == 1 and "month" in back.columns
    out = writers.write_csv(df, os.path.join(tmpdir_path, "csv"))
    txt = spark.read.option("header", True).csv(out).collect()[0]
    assert txt["date"] == "02/01/2024" and txt["ts"] == "02/01/2024 03:04"


def test_publish_job_writes_all_tables(spark, tmpdir_path):
    from pluvio.plans import publish
    tables = publish.build(spark, "/root/testdata/sf0.001")
    paths = writers.publish(tables, tmpdir_path, "r1", {"hydro_incident_daily": ["month"]})
    assert set(paths) == set(tables)
    assert spark.read.parquet(paths["hydro_incident_daily"]).count() == 36


def test_optional_sources(spark):
    from pluvio.plans import fixtures as fx
    from pluvio.plans import pipelines as pl
    inp = pl.Inputs(readings=fx.readings(spark, "/root/testdata/sf0.001"), rules=fx.RULES,
                    period=fx.PERIOD)
    t = pl.hydro_daily(spark, inp)
    assert t.count() == 36 and not [c for c in t.columns if c.startswith(("total_", "sta_", "rain_cfsr"))]
    h = pl.hourly_table(inp)
    assert "quality_sta" not in h.columns and h.count() > 0


def test_reference_defaults():
    from pluvio.plans import pipelines as pl
    r, p = pl.GaugeRules(), pl.Period()
    assert (r.low, r.high, len(r.problem_dates), r.minutes, r.rolling_width) == (10.0, 100000.0, 3, 15, 12)
    assert (p.spine_start, p.spine_end) == ("2020-01-01", "2020-11-30")


def test_vertex_file_to_spatial_join(spark, tmpdir_path):
    from pluvio.operators import geo
    p = os.path.join(tmpdir_path, "camps.csv")
    _write(p, "Camp_Name,seq,x,y\nCamp 1,0,0,0\nCamp 1,1,2,0\nCamp 1,2,2,2\nCamp 1,3,0,2\n")
    v = readers.read_vertices(spark, p, name="camp_name", seq="seq", x="x", y="y")
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 1.0)], "point_id long, x double, y double")
    got = rows(geo.locate(pts, geo.polygon_edges(v), "point_id"), "point_id", "polygon_name")
    assert got == [(1, "Camp 1"), (2, None)]


def test_folder_read_drops_unnamed_columns(spark, tmpdir_path):
    _write(os.path.join(tmpdir_path, "a_GSB.csv"), "Date,G1,,X.5\n01/06/2020 00:00,3,,z\n")
    df = readers.read_folder(spark, tmpdir_path, "*GSB*", drop_unnamed=True)
    assert df.columns == ["date", "g1"]


def test_flagship_with_official_and_chirps(spark):
    from pluvio.plans import fixtures as fx
    from pluvio.plans import pipelines as pl
    per = pl.Period(spine_start="2024-01-01", spine_end="2024-01-10", official_year=2024,
                    official_start="2024-01-03")
    off = spark.createDataFrame([(1, "01/05/2024", "12.5"), (2, "01/07/2024", "T"), (3, "Date", "Rainfall (mm)")],
                                "row_id long, date string, rainfall_mm string")
    chirps = spark.createDataFrame([("2024-01-02", 3.456), ("2024-01-04", None)],
                                   "system_time_start string, precipitation double")
    inp = pl.Inputs(readings=fx.readings(spark, "/root/testdata/sf0.001"), rules=fx.RULES,
                    period=per, official={"gauge_house": off}, chirps=chirps)
    t = {r["date"]: r for r in pl.hydro_daily(spark, inp).collect()}
    assert len(t) == 10
    assert t[dt.date(2024, 1, 1)]["quality_gauge_house"] == "-"               # before the first reported day
    assert (t[dt.date(2024, 1, 5)]["rain_gauge_house"], t[dt.date(2024, 1, 5)]["quality_gauge_house"]) == (12.5, None)
    assert (t[dt.date(2024, 1, 7)]["rain_gauge_house"], t[dt.date(2024, 1, 7)]["quality_gauge_house"]) == (0.5, "Trace")
    assert t[dt.date(2024, 1, 8)]["quality_gauge_house"] == "Missing data"
    assert t[dt.date(2024, 1, 2)]["rain_chirps"] == 3.46 and t[dt.date(2024, 1, 4)]["rain_chirps"] is None


def test_quoted_line_breaks_and_quotes(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "i.csv")
    _write(p, 'UID,Comment,Type\n1,"two\nlines, and ""quotes""",Flood\n2,plain,Fire\n')
    got = rows(readers.read_delimited(spark, p), "uid", "comment", "type")
    assert got == [("1", 'two\nlines, and "quotes"', "Flood"), ("2", "plain", "Fire")]


def test_two_line_header_with_a_shorter_first_line(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "s.txt")
    _write(p, "\t\tHi\nDate\tTime\tTemp\tRain\tBar\n1/6/20\t1:00 a\t30\t0.2\t1001\n")
    df = readers.read_two_line_header(spark, p)
    assert len(df.columns) == 5 and df.columns[-2:] == ["rain", "bar"]
    assert rows(df, *df.columns) == [("1/6/20", "1:00 a", "30", "0.2", "1001")]


def test_long_rename_map(spark):
    from pluvio.operators import columns
    m = spark.range(10_050).selectExpr("concat('c', id) AS old_name", "concat('n', id) AS new_name")
    df = spark.createDataFrame([(1, 2, 3)], "c3 int, c10049 int, other int")
    assert columns.rename_by_table(df, m).columns == ["n3", "n10049", "other"]


def test_official_series_without_row_ids(spark):
    from pluvio.plans import pipelines as pl
    off = spark.createDataFrame([("01/05/2024", "1.5")], "date string, rainfall_mm string")
    assert pl.official_series(off, 2024).columns == ["date_text", "date", "rain_official", "quality_official"]
