import datetime as dt


from pluvio.operators import quality, records
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)


def slot(i):
    return T0 + dt.timedelta(minutes=15 * i)


def test_anomaly_only_on_listed_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 1), 500.0), (dt.datetime(2024, 1, 5, 2), None),
                                (dt.datetime(2024, 1, 7, 1), 500.0), (dt.datetime(2024, 1, 5, 3), 50.0)],
                               "ts timestamp_ntz, value double")
    out = rows(quality.anomaly_mask(df, ["2024-01-05"], 1, 100), "ts", "value", "quality")
    assert out[0] == (dt.datetime(2024, 1, 5, 1), None, quality.ANOMALY_TEXT)
    assert out[1] == (dt.datetime(2024, 1, 5, 2), None, None)
    assert out[2] == (dt.datetime(2024, 1, 5, 3), 50.0, None)
    assert out[3] == (dt.datetime(2024, 1, 7, 1), 500.0, None)


def test_reset_flags_empty_after_clamp(spark):
    df = spark.createDataFrame([("a", slot(0), 0.0, -3.0)], "device string, slot timestamp_ntz, interval double, raw_interval double")
    assert quality.reset_flags(df).count() == 0
    assert quality.reset_flags(df, flag_before_clamp=True).count() == 1


def test_gap_first_slot_and_missing(spark):
    acc = [1.0, None, 2.0, 3.0]
    df = spark.createDataFrame([("a", slot(i), v, "x" if i == 3 else None) for i, v in enumerate(acc)],
                               "device string, slot timestamp_ntz, accumulated double, quality string")
    g = quality.gap_flag(df)
    got = [r["quality"] for r in g.orderBy("slot").collect()]
    assert got == [quality.GAP_TEXT, None, quality.GAP_TEXT, "x"]
    m = quality.missing_flag(quality.null_first_slot(g), "accumulated")
    assert [r["quality"] for r in m.orderBy("slot").collect()] == [None, "Missing", quality.GAP_TEXT, "x"]


def test_merge_flags_one_per_slot(spark):
    a = spark.createDataFrame([("a", slot(0), "b-text"), ("a", slot(0), "a-text")], "device string, slot timestamp_ntz, quality string")
    b = spark.createDataFrame([("a", slot(0), "c-text"), ("a", slot(1), "c-text")], "device string, slot timestamp_ntz, quality string")
    assert rows(quality.merge_flags(a, b), "slot", "quality") == [(slot(0), "a-text"), (slot(1), "c-text")]


def test_station_and_official_flags(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), None, None, None), (dt.date(2024, 1, 30), None, 1.0, None),
                                (dt.date(2024, 1, 10), None, None, "Trace"), (dt.date(2024, 1, 10), 3.0, 2.0, None)],
                               "d date, probe double, rain double, tr string")
    st = [r[0] for r in df.select(quality.station_flag("d", "probe", "2024-01-08", "2024-01-22")).collect()]
    assert st == ["-", quality.AFTER_END_TEXT, "missing", None]
    of = [r[0] for r in df.select(quality.official_flag("d", "rain", "tr", "2024-01-05")).collect()]
    assert of == ["-", None, "Trace", None]


MEAS = ["hh", "ind"]


def _inc(spark, data):
    return spark.createDataFrame(data, "date_of_incident date, type_of_incident string, incident string, hh double, ind double")


def test_incident_pivot_strict_then_zero(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = _inc(spark, [(d1, "Flood", "Yes", 2.0, 1.0), (d1, "Flood", "Yes", None, 1.0),
                      (d1, "Wind-Storm", "Yes", 3.0, 4.0), (d2, "Fire", "Yes", 9.0, 9.0),
                      (d2, "Flood", "No", 9.0, 9.0), (None, "Flood", "Yes", 1.0, 1.0)])
    p = records.incident_pivot(records.reported_incidents(df), MEAS)
    r = {x["date"]: x for x in p.collect()}
    assert set(r) == {d1}                       # d2 has no hazard row confirmed; null date dropped
    assert r[d1]["hh_Flood"] == 0.0             # one unknown voids the cell, reported as 0
    assert r[d1]["ind_Flood"] == 2.0 and r[d1]["hh_Wind-Storm"] == 3.0 and r[d1]["hh_Slope-failure"] == 0.0


def test_hazard_totals(spark):
    df = spark.createDataFrame([(None, None, None), (1.0, None, 0.0)],
                               "`hh_Flood` double, `hh_Slope-failure` double, `hh_Wind-Storm` double")
    assert [r[0] for r in records.hazard_totals(df, ["hh"]).select("total_hh").collect()] == [None, 1.0]


def test_date_fallback_and_clean(spark):
    df = spark.createDataFrame([("03/01/2024", None, "Yes", "Lightning ", None, "u1", 1.5, "org"),
                                ("03/01/2024", "01/01/2024", "Yes", "Other", 1.0, "u2", 1.5, "org")],
                               "date_of_assessment string, date_of_incident string, incident string, "
                               "type_of_incident string, hh double, uid string, gps_lat double, organization string")
    p = records.parse_incident_dates(df)
    assert rows(p, "uid", "date_of_incident") == [("u1", dt.date(2024, 1, 3)), ("u2", dt.date(2024, 1, 1))]
    c = records.clean_records(p)
    assert c.columns == ["date_of_incident", "type_of_incident", "hh"]
    assert rows(c) == [(dt.date(2024, 1, 3), "Lightning ", 0.0)]


def test_published_records_leave_out_all_listed_columns(spark):
    from pluvio.operators import records
    df = spark.createDataFrame([("Yes", "Flood", "2020-06-01", 1, "x", "x", "x", "x", "x", 2)],
                               "incident string, type_of_incident string, date_of_incident string, hh int, location_access string, "
                               "traffic_x string, required_response_wash string, additional_comments string, "
                               "protection_concern_ string, shelter_other_ int")
    assert records.clean_records(df).columns == ["date_of_incident", "type_of_incident", "hh", "shelter_other"]
