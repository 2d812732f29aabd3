import datetime as dt


from pluvio.operators import coverage, weather
from tests.conftest import rows


def h(day, hour):
    return dt.datetime(2024, 1, day, hour)


def test_daily_weather_lead_drives_and_null_rules(spark):
    lead = spark.createDataFrame([(h(1, 0), 10.0, 5.0, 1.0, 0.5, "N"), (h(1, 1), 20.0, None, 3.0, None, "S"),
                                  (h(2, 0), None, None, None, None, None)],
                                 "time_date timestamp_ntz, sta_hi_temp double, sta_low_temp double, "
                                 "sta_temp_out double, sta_rain double, sta_wind_dir string")
    other = spark.createDataFrame([(h(1, 0), 7.0, 2.0), (h(3, 0), 99.0, 9.0)],
                                  "time_date timestamp_ntz, stb_hi_temp double, stb_rain double")
    d = {r["date"]: r for r in weather.daily_weather(lead, other).collect()}
    assert set(d) == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}   # other-only day 3 is lost
    r1, r2 = d[dt.date(2024, 1, 1)], d[dt.date(2024, 1, 2)]
    assert r1["sta_hi_temp"] == 20.0 and r1["sta_low_temp"] == 5.0 and r1["sta_temp_out"] == 2.0
    assert r1["sta_rain"] == 0.5 and r1["stb_rain"] == 2.0 and r1["stb_hi_temp"] == 7.0
    assert "sta_wind_dir" not in weather.daily_weather(lead, other).columns
    assert r2["sta_hi_temp"] is None and r2["sta_low_temp"] is None and r2["sta_rain"] == 0.0


def test_parse_station_sentinels_and_shift(spark):
    raw = spark.createDataFrame([("6/1/20", "11:00 p", "25.5", "---", "NNE"), ("6/1/20", "11:00 p", "25.5", "---", "NNE")],
                                "x_date string, x_time string, t string, hi string, d string")
    out = weather.parse_station(raw, {"t": "temp_out", "hi": "hi_temp", "d": "wind_dir"}, "s_", shift_hours=12,
                                text=("d",)).collect()
    assert len(out) == 1
    assert out[0]["time_date"] == dt.datetime(2020, 6, 2, 11, 0)
    assert out[0]["s_hi_temp"] is None and out[0]["s_temp_out"] == 25.5 and out[0]["s_wind_dir"] == "NNE"


def _grid(spark, hours_with_data):
    data = []
    for day in (1, 2):
        for q in range(96):
            t = dt.datetime(2024, 1, day) + dt.timedelta(minutes=15 * q)
            data.append(("g", t, 1.0 if (day, t.hour) in hours_with_data else None))
    return spark.createDataFrame(data, "device string, slot timestamp_ntz, interval double")


def test_usable_day_needs_more_than_one_bin(spark):
    g = _grid(spark, {(1, 1), (1, 9), (2, 3)})          # day 1: two bins with data, day 2: one
    b = coverage.bin_availability(g)
    u = {r["date"]: r["useable"] for r in coverage.usable_days(b).collect()}
    assert u == {dt.date(2024, 1, 1): 1, dt.date(2024, 1, 2): 0}
    m = coverage.month_coverage(b).collect()[0]
    assert (m["count"], m["number_of_days"]) == (1, 31) and abs(m["percent"] - 100 / 31) < 1e-9
    c = coverage.device_completeness(b).collect()[0]
    assert (c["total_data"], c["available_data"]) == (192, 12)


def test_frequency_table_order_and_running(spark):
    df = spark.createDataFrame([("g", v) for v in [0.0, 0.0, 0.0, 2.0, 1.0, 1.0, None]],
                               "device string, interval double")
    got = rows(coverage.frequency_table(df), "item", "count", "cum_count", "cum_percent")
    assert got == [(0.0, 3, 3, 50.0), (1.0, 2, 5, 5 / 6 * 100), (2.0, 1, 6, 100.0)]


def test_column_classes_ignore_case(spark):
    df = spark.createDataFrame([(h(1, 0), 1.0, 2.0, 3.0, 4.0), (h(1, 1), 5.0, 0.5, 1.0, 2.0)],
                               "time_date timestamp_ntz, ST_HI_Temp double, st_LOW_temp double, "
                               "St_RAIN double, st_bar double")
    r = weather.daily_weather(df, None).collect()[0]
    assert (r["ST_HI_Temp"], r["st_LOW_temp"], r["St_RAIN"], r["st_bar"]) == (5.0, 0.5, 4.0, 3.0)
