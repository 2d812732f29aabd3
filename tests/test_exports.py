"""Small exports of every kind, published, against values worked out by hand."""
import datetime as dt
import os

import pytest

from pluvio.operators import reshape
from pluvio.plans import exports, publish
from pluvio.plans import pipelines as pl
from pluvio.sources import readers
from tests.conftest import rows

MEASURES = ("Number.of.incidents,Affected.HHs,Affected.individuals,Casualties..ind.,Missing.ind,Injured.ind,"
            "Displaced.HH,Displaced.ind,Partially.Damaged.shelters,Totally.Damaged.shelters,Damaged.waterpoints,"
            "Damaged.latrines,Damaged.health.facilities,Damaged.food.distribution.site")
HEAD = ("Date.of.assessment,Date.of.incident,Incident,Type.of.incident," + MEASURES
        + ",Camp,GPS.Log,GPS.Lat,Incident.picture,UID,Time.of.submission,Organization,Additional.comments\n")


def _incident(assessed, happened, flag, kind, hhs, uid, camp="Camp 01", x="1", y="1"):
    return (f"{assessed},{happened},{flag},{kind},1,{hhs},20" + ",0" * 11
            + f',{camp},{x},{y},p.jpg,{uid},10:00,org,"said ""wet"",\nthen dry"\n')


FILES = {
    "gauges/a_reporting.csv": "Time,Device.name,Value\n2020-06-01 00:00:00,South,10\n2020-06-01 00:15:00,South,11\n"
                              "2020-06-01 00:30:00,South,11.5\n",
    "gauges/b_reporting.csv": "Device.name,Value,Time\nSouth,11.50,2020-06-01 00:30:00\nSouth,13,2020-06-01 00:45:00\n"
                              "South,99,not a time\n",
    "gauges/c_GSB.csv": "Date,Gauge.South,North,\n02/06/2020 00:00,14,5,\n2/6/2020 0:15,15,7,\n03/06/2020 00:00,16,7,\n",
    "new.csv": HEAD + _incident("02/06/2020", "01/06/2020", "Yes", "Flood", 4, "u1")
               + _incident("01/06/2020", "", "Yes", "Flood", 6, "u2", "Camp 2")
               + _incident("02/06/2020", "02/06/2020", "Yes", "Fire", 3, "u3", x="n/a")
               + _incident("09/06/2020", "09/06/2020", "No", "Flood", 50, "u4"),
    "old.csv": HEAD + _incident("31/12/2019", "31/12/2019", "Yes", "Wind-Storm", 1, "o1")
               + _incident("02/01/2020", "02/01/2020", "Yes", "Flood", 1, "o2"),
    "lead.txt": "\t\tTemp\tHi\tLow\tWind\tWind\tHi\tHi\t\t\tRain\n"
                "Date\tTime\tOut\tTemp\tTemp\tSpeed\tDir\tSpeed\tDir\tBar\tRain\tRate\n"
                "6/1/20\t12:00 a\t25\t---\t24\t1\tN\t2\tS\t------\t0.2\t0\n"
                "6/1/20\t1:00 a\t26\t30\t23\t1\tN\t5\tS\t1001\t0.3\t0\n"
                "6/5/20\t1:00 a\t40\t40\t40\t1\tN\t5\tS\t1001\t9\t0\n",
    "other.txt": "\t\tTemp\tHi\tLow\tWind\tWind\tHi\tHi\t\t\tRain\tHi\tUV\n"
                 "Date\tTime\tOut\tTemp\tTemp\tSpeed\tDir\tSpeed\tDir\tBar\tRain\tRate\tSolar Rad.\tIndex\n"
                 "5/31/20\t12:00 p\t25\t31\t24\t1\tN\t2\tS\t1000\t0\t0\t120\t2\n",
    "off.csv": "Date,Rainfall (mm),\n06/01/2020,12.5,\nDate,Rainfall (mm),\n06/02/2020,T,\n,,\n",
    "chirps.csv": "system.time_start,precipitation\n2020-06-01,3.456\n",
    "cfsr.csv": "system.time_start,Precipitation_rate_surface_6_Hour_Average\n2020-06-01,0.0001\n2020-06-01,0.0001\n",
    "camps.csv": "Camp_Name,seq,x,y\nCamp 1,0,0,0\nCamp 1,1,2,0\nCamp 1,2,2,2\nCamp 1,3,0,2\n",
    "names.csv": "old_name,new_name\nCamp 01,Camp 1\n",
    "renames.csv": "old_name,new_name,dataset,,\nrain_South,rain.South,Hydro-incident dataset,,\n"
                   "datehour,Date hour,Hourly Summary,,\ndate_time,,Field Measurements,,\n",
}


@pytest.fixture
def layout(tmpdir_path):
    for name, text in FILES.items():
        path = os.path.join(tmpdir_path, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    at = lambda name: os.path.join(tmpdir_path, name)
    return exports.Layout(gauges=at("gauges"), device_names={"gauge_south": "South", "north": "North"}, incidents=at("new.csv"),
                          older_incidents=at("old.csv"), lead_station=at("lead.txt"), other_station=at("other.txt"),
                          official={"house": at("off.csv")}, chirps=at("chirps.csv"), satellite=at("cfsr.csv"),
                          polygons=at("camps.csv"), camp_names=at("names.csv"), renames=at("renames.csv"))


PERIOD = pl.Period(spine_start="2020-05-31", spine_end="2020-06-03")


def test_exports_to_published_tables(spark, layout, tmpdir_path):
    out = publish.from_exports(spark, layout, period=PERIOD)
    paths = publish.write(out, os.path.join(tmpdir_path, "out"), "r1")
    t = {n: spark.read.parquet(p) for n, p in paths.items()}
    day = {str(r["date"]): r for r in t["hydro_incident_daily"].collect()}
    assert sorted(day) == ["2020-05-31", "2020-06-01", "2020-06-02", "2020-06-03"]
    d1, d2 = day["2020-06-01"], day["2020-06-02"]
    assert (d1["rain.South"], d1["rain_max_3h_South"], d1["rain_North"], d2["rain.South"], d2["rain_North"]) == (
        3.0, 3.0, None, 2.0, 2.0)
    assert (d1["number_of_incidents_Flood"], d1["total_affected_hhs"], d1["total_displaced_hh"]) == (2.0, 10.0, 0.0)
    assert d2["total_affected_hhs"] is None and "total_casualties_ind" not in t["hydro_incident_daily"].columns
    assert (d1["rain_house"], d1["quality_house"], d2["rain_house"], d2["quality_house"]) == (12.5, None, 0.5, "Trace")
    assert (d1["rain_chirps"], d1["rain_cfsr"]) == (3.46, 4.33)
    assert (d1["sta_hi_temp"], d1["sta_low_temp"], d1["sta_rain"], d1["sta_hi_speed"], d1["stb_hi_solar_rad"]) == (
        30.0, 23.0, 0.5, 5.0, 120.0)
    hour = {r["Date hour"]: r for r in t["weather_hourly"].collect()}
    h0 = hour[dt.datetime(2020, 6, 1)]
    assert (h0["precip_South"], h0["sta_temp_out"], h0["sta_hi_temp"], h0["stb_uv_index"], h0["quality_stb"]) == (
        3.0, 25.0, None, 2.0, None)
    assert hour[dt.datetime(2020, 6, 1, 2)]["quality_sta"] == "-"     # before the stations' period
    slot = {r["date_time"]: r for r in t["gauges_subhourly"].collect()}
    s = slot[dt.datetime(2020, 6, 1, 0, 30)]
    assert (s["cumulative_rain_South"], s["rain_South"], s["quality_South"], s["quality_North"]) == (11.5, 0.5, None, "Missing")
    assert rows(t["incident_records"], "date_of_incident", "type_of_incident", "affected_hhs") == [
        (dt.date(2019, 12, 31), "Wind-Storm", 1.0), (dt.date(2020, 6, 1), "Flood", 4.0),
        (dt.date(2020, 6, 1), "Flood", 6.0), (dt.date(2020, 6, 2), "Fire", 3.0)]
    assert not {"uid", "organization", "additional_comments", "gps_log"} & set(t["incident_records"].columns)
    assert rows(t["reading_counts"]) == [(11, 1, 0)]
    assert rows(t["incident_gps_check"], "point_id", "camp_name_reported", "camp_name_gps", "camp_consistency") == [
        ("u1", "Camp 1", "Camp 1", True), ("u2", "Camp 2", "Camp 1", False)]
    assert rows(t["incidents_without_coordinate"], "point_id") == [("u3",)]
    assert rows(t["gauge_days"].filter("device = 'South'"), "interval") == [(2.0,), (3.0,)]


def test_more_gauges_than_columns(spark, layout, monkeypatch):
    monkeypatch.setattr(reshape, "MAX_PIVOT_VALUES", 1)
    out = publish.tables(spark, exports.inputs(spark, layout, period=PERIOD))
    assert not [c for c in out["hydro_incident_daily"].columns if "South" in c]
    assert out["hydro_incident_daily"].count() == 4 and out["gauges_subhourly"].columns == ["date_time"]
    assert rows(out["gauge_slots"].select("device").distinct()) == [("North",), ("South",)]


def test_only_gauges(spark, layout):
    out = publish.from_exports(spark, exports.Layout(gauges=layout.gauges), period=PERIOD)
    assert out["hydro_incident_daily"].count() == 4 and "incident_records" not in out


def test_one_scan_a_header(spark, tmpdir_path):
    heads = ("a,b,c", "b,a,c", '"a, with a comma",b,c')
    for i in range(45):
        with open(os.path.join(tmpdir_path, f"f{i}_reporting.csv"), "w") as f:
            f.write(heads[i % 3] + ("\r\n" if i % 2 else "\n") + f"{i},x{i},y\n")
    df = readers.read_folder(spark, tmpdir_path, "*reporting*")
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3
    got = {(r["a"], r["b"], r["a_with_a_comma"]) for r in df.collect()}
    want = {(str(i), f"x{i}", None) if i % 3 == 0 else (f"x{i}", str(i), None) if i % 3 == 1 else (None, f"x{i}", str(i))
            for i in range(45)}
    assert got == want and df.count() == 45
