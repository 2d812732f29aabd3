"""The query catalogue: one callable (spark, sf_dir) -> DataFrame per operator key.

Every query reads the driver tables (through the stand-in inputs of
``fixtures``) over their whole extent and runs the library's operators on them.
Float results are rounded to 4 places at the very end (publication/oracle
comparison); nothing is sampled, capped or subset.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.dates import ampm_timestamp
from pluvio.functions.nulls import null_tokens, r_if_else, round_floats, zero_fill
from pluvio.operators import columns, coverage, geo, quality, records, reshape, series, weather
from pluvio.operators.joins import left_join_as
from pluvio.plans import fixtures as fx
from pluvio.plans import pipelines as pl
from pluvio.plans import publish
from pluvio.session import pin, shared_folder
from pluvio.sinks import writers
from pluvio.sources.generated import calendar, calendar_over

DEV = "device"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    name = fn.__name__.removeprefix("q_")

    def run(spark, sf_dir):
        return round_floats(fn(spark, sf_dir), 4)

    run.__name__ = name
    run.__doc__ = fn.__doc__
    QUERIES[name] = run
    return fn


def T(spark, d, name):
    return fx.table(spark, d, name)


def _inp(spark, d, **kw):
    return fx.inputs(spark, d, **kw)


def _buckets(spark, d):
    """15-minute means of the readings, pinned: the readings are scanned and
    shuffled once, and every branch (halo summary, grid bounds, grid keys) reads
    the small pinned table."""
    return pin(series.bucket_mean(fx.readings(spark, d), (DEV,), "ts", "value", 15))


# ------------------------------------------------------------------ sources / schema
@query
def q_null_tokens(spark, d):
    """Order status read with 'P' and 'O' as null tokens; rows per value."""
    o = T(spark, d, "orders").select(null_tokens("o_orderstatus", ["P", "O"]).alias("o_orderstatus"))
    return o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query
def q_rename_map(spark, d):
    """Nation renamed from a mapping table; blank and absent names ignored."""
    m = spark.createDataFrame(
        [("n_nationkey", "nation_key", "nation"), ("n_name", "nation_name", "nation"),
         ("n_comment", "comment", "nation"), ("n_regionkey", None, "nation"),
         (None, "orphan", "nation"), ("n_name", "NAME", "other")],
        "old_name string, new_name string, dataset string")
    return columns.rename_by_table(T(spark, d, "nation"), m, "nation")


@query
def q_select_reorder(spark, d):
    """Orders with date and key first, then every other column."""
    return columns.select_first(T(spark, d, "orders"), "o_orderdate", "o_orderkey")


@query
def q_select_prefix(spark, d):
    """Only the o_order* columns of orders."""
    return columns.select_prefix(T(spark, d, "orders"), "o_order")


@query
def q_add_missing_cols(spark, d):
    """Order key and status; of the wanted columns, the absent one is added as a
    typed null and the present one is kept."""
    o = T(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return columns.add_missing(o, ["o_orderstatus", "quality_extra"])


@query
def q_regex_columns(spark, d):
    """Orders with '_' removed from every column name."""
    return columns.rename_regex(T(spark, d, "orders"), [("_", "")])


@query
def q_zero_fill(spark, d):
    """Incident measures with null -> 0 on numeric columns."""
    x = fx.incident_export(spark, d).select("uid", *records.MEASURES)
    return zero_fill(x)


@query
def q_sentinel_null(spark, d):
    """Station text with '---' / '------' sentinels -> null, then numbers."""
    s = fx.station_export(spark, d, 0)
    tok = weather.STATION_SENTINELS
    return s.select("x_date", "x_time",
                    (null_tokens("hi_temp", tok)).try_cast("double").alias("hi_temp"),
                    (null_tokens("bar", tok)).try_cast("double").alias("bar"))


@query
def q_filter_membership(spark, d):
    """Membership and null-safe non-membership tests on incident columns."""
    x = fx.incident_export(spark, d)
    hz = list(records.HAZARDS)
    small = F.col("affected_hhs").isin([1.0, 2.0, 3.0])
    return x.select("uid", F.col("type_of_incident").isin(hz).alias("is_hazard"),
                    (~F.coalesce(F.col("type_of_incident").isin(hz), F.lit(False))).alias("not_hazard"),
                    small.alias("hh_small"), (~F.coalesce(small, F.lit(False))).alias("hh_not_small"))


@query
def q_split_by_null(spark, d):
    """Points split by missing coordinates: no longitude / both present / neither part."""
    p = fx.points(spark, d)
    p = p.withColumns({"x": F.when(F.col("point_id") % 23 == 0, None).otherwise(F.col("x")),
                       "y": F.when(F.col("point_id") % 19 == 0, None).otherwise(F.col("y"))})
    part = (F.when(F.col("x").isNull(), "no_coordinate")
            .when(F.col("y").isNotNull(), "with_coordinate").otherwise("neither"))
    return p.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def _with_missing(spark, d):
    p = fx.points(spark, d)
    return p.withColumns({"x": F.when(F.col("point_id") % 23 == 0, None).otherwise(F.col("x")),
                          "y": F.when(F.col("point_id") % 19 == 0, None).otherwise(F.col("y"))})


@query
def q_points_without_coordinate(spark, d):
    """Side table of the points whose x is missing."""
    return _with_missing(spark, d).filter(F.col("x").isNull()).select("point_id", F.round("y", 4).alias("y"))


@query
def q_points_with_coordinate(spark, d):
    """The points that have both coordinates."""
    p = _with_missing(spark, d).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    return p.select("point_id", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query
def q_flagged_slots(spark, d):
    """Side table of the slots that carry an anomaly flag."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    return quality.flagged_rows(inp.slots().withColumnRenamed("anomaly", "quality"), (DEV,))


@query
def q_merge_periods(spark, d):
    """Older extract (orders) cut before 1998 plus the newer one (line items) whole."""
    old = T(spark, d, "orders").select(F.col("o_orderkey").alias("record_key"),
                                       F.to_date("o_orderdate").alias("date_of_incident"),
                                       F.col("o_totalprice").alias("amount"))
    new = T(spark, d, "lineitem").select(F.col("l_orderkey").alias("record_key"),
                                         F.to_date("l_shipdate").alias("date_of_incident"),
                                         F.col("l_quantity").alias("quantity"))
    return records.merge_periods(old, new, "1998-01-01")


@query
def q_drop_last_day(spark, d):
    """Readings before the last calendar day present."""
    return series.drop_last_day(fx.readings(spark, d), "ts")


@query
def q_cutoff_by_other(spark, d):
    """Line items shipped no later than the latest order date."""
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return weather.cut_after(li, "l_shipdate", T(spark, d, "orders"), "o_orderdate")


@query
def q_calendar_spine(spark, d):
    """Every day between the first and the last order, with order count and value (null
    when none)."""
    o = T(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_price"))
    return calendar_over(o, "date").join(o, on="date", how="left")


@query
def q_full_outer_daily(spark, d):
    """Daily order counts full-joined with daily shipment counts."""
    o = T(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    s = T(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("n_shipments"))
    return o.join(s, on="date", how="full")


# ------------------------------------------------------------------ gauge series
@query
def q_bucket_mean(spark, d):
    """15-minute mean per gauge."""
    return series.bucket_mean(fx.readings(spark, d), (DEV,), "ts", "value", 15)


@query
def q_counter_diff(spark, d):
    """15-minute means differenced against the previous existing slot, negatives -> 0."""
    return series.counter_diff(_buckets(spark, d), (DEV,), "slot", "value", "interval").drop("value")


@query
def q_reset_flags(spark, d):
    """Slots whose difference is negative (tested before the clamp)."""
    c = series.counter_diff(_buckets(spark, d), keep_raw="raw_interval")
    return quality.reset_flags(c, flag_before_clamp=True)


@query
def q_dense_grid(spark, d):
    """15-minute means on the complete grid (device x slot), null where absent."""
    return series.densify(_buckets(spark, d))


@query
def q_grid_left_join(spark, d):
    """Grid (time_date) left-joined to the differences keyed by slot."""
    b = _buckets(spark, d)
    c = series.counter_diff(b).select(DEV, "slot", "interval")
    grid = series.time_grid(b).withColumnRenamed("slot", "time_date")
    return left_join_as(grid, c, {DEV: DEV, "time_date": "slot"})


@query
def q_rolling_3h(spark, d):
    """Grid without its last day plus the full-window 3-hour sum per (gauge, day)."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    r = pl.rolled(pl.gridded(inp), inp.rules, inp.last_day())
    return r.select(DEV, "slot", "interval", "max_3_hour")


@query
def q_daily_rain_basic(spark, d):
    """Readings -> 15-min mean -> clamped difference -> daily null-preserving sum."""
    c = series.with_day(series.counter_diff(_buckets(spark, d)))
    return c.groupBy("date", DEV).agg(F.sum("interval").alias("interval"))


@query
def q_daily_rain(spark, d):
    """Daily rain and largest 3-hour sum per gauge (max nulled with the total)."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    return series.daily_rain(pl.rolled(pl.gridded(inp), inp.rules, inp.last_day()))


@query
def q_hourly_rain(spark, d):
    """Hourly null-preserving rain sum per gauge."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    return series.hourly_sum(pl.rolled(pl.gridded(inp), inp.rules, inp.last_day()))


@query
def q_hourly_weather(spark, d):
    """Hourly gauge sums (wide) joined to both stations by hour, with period flags."""
    return pl.hourly_table(_inp(spark, d, with_satellite=False))


@query
def q_satellite_daily(spark, d):
    """6-hourly rate -> daily mm, zero on empty, 2 places."""
    return pl.satellite_daily(fx.satellite_export(spark, d))


@query
def q_incident_pivot(spark, d):
    """Date x hazard x measure strict sums, void cells -> 0."""
    return pl.incident_daily(pl.parsed_incidents(fx.incident_export(spark, d)))


@query
def q_row_totals(spark, d):
    """Incident pivot on the reporting calendar with hazard totals (null on empty days)."""
    p = pl.incident_daily(pl.parsed_incidents(fx.incident_export(spark, d)))
    per = fx.PERIOD
    x = calendar(spark, per.spine_start, per.spine_end).join(p, on="date", how="left")
    return records.hazard_totals(x, records.PUBLISHED_MEASURES)


@query
def q_date_fallback(spark, d):
    """Incident and assessment dates parsed; missing incident date -> assessment date."""
    x = pl.parsed_incidents(fx.incident_export(spark, d))
    return x.select("uid", "date_of_assessment", "date_of_incident")


@query
def q_parse_mixed_times(spark, d):
    """Gauge exports unioned, de-duplicated, two time spellings parsed into one."""
    return pl.gauge_ingest(fx.gauge_exports(spark, d))


@query
def q_ampm_shift(spark, d):
    """Late station's 12-hour text clock parsed and shifted by 12 hours."""
    s = fx.station_export(spark, d, 1, 12)
    return s.select("x_date", "x_time", ampm_timestamp("x_date", "x_time", 12).alias("time_date"))


@query
def q_ambiguous_dates(spark, d):
    """Official rain dates written day-first or month-first, read by the >12 rule."""
    o = pl.official_series(fx.official_export(spark, d), fx.ORDER_PERIOD.official_year)
    return o.select("row_id", "date_text", "date")


@query
def q_trace_rain(spark, d):
    """Official rain text: 'T' -> 0.5 mm with a 'Trace' flag, else a number."""
    o = pl.official_series(fx.official_export(spark, d), fx.ORDER_PERIOD.official_year)
    return o.select("row_id", "rain_official", "quality_official")


@query
def q_if_else_null(spark, d):
    """Two-way label that stays null when the tested value is null."""
    r = fx.readings(spark, d)
    return r.select(DEV, "ts", r_if_else(F.col("value") > 100, F.lit("high"), F.lit("low")).alias("level"))


@query
def q_dedup_rows(spark, d):
    """Overlapping gauge exports unioned by name, whole-row duplicates removed."""
    ex = fx.gauge_exports(spark, d)
    u = ex[0]
    for e in ex[1:]:
        u = u.unionByName(e, allowMissingColumns=True)
    return u.dropDuplicates()


@query
def q_union_by_name(spark, d):
    """Gauge exports with different columns unioned by name (missing -> null)."""
    ex = fx.gauge_exports(spark, d)
    u = ex[0]
    for e in ex[1:]:
        u = u.unionByName(e, allowMissingColumns=True)
    return u


@query
def q_distinct_values(spark, d):
    """Distinct gauge names."""
    return fx.readings(spark, d).select(DEV).distinct()


def _daily(spark, d):
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    return inp, series.daily_rain(pl.rolled(pl.gridded(inp), inp.rules, inp.last_day()))


@query
def q_unpivot_series(spark, d):
    """Daily rain wide -> long (date, device, rain), null cells kept."""
    inp, daily = _daily(spark, d)
    wide = reshape.pivot(daily, ["date"], DEV, inp.device_list(), {"": F.first("interval")})
    return reshape.unpivot(wide, ["date"], DEV, "rain")


@query
def q_pivot_series(spark, d):
    """Sub-hourly intervals spread into interval_<device> columns."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    g = pl.gridded(inp)
    return reshape.pivot_prefixed(g, ["slot"], DEV, inp.device_list(), "interval", "interval_")


@query
def q_pivot_multi(spark, d):
    """Daily rain and 3-hour maximum pivoted together by device."""
    inp, daily = _daily(spark, d)
    return pl.daily_rain_wide(daily, inp.device_list())


# ------------------------------------------------------------------ quality
RULES = fx.RULES


@query
def q_anomaly_mask(spark, d):
    """Readings on the problem dates outside [low, high]: value nulled, reason kept."""
    return quality.anomaly_mask(fx.readings(spark, d), RULES.problem_dates, RULES.low, RULES.high)


@query
def q_merge_flags(spark, d):
    """Anomaly flags and counter-reset flags merged to one per (device, slot).
    Both come from the one slot aggregation of the readings (anomaly flag per
    slot = smallest flag text of its readings)."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    s = inp.slots()
    a = s.filter(F.col("anomaly").isNotNull()).select(DEV, "slot", F.col("anomaly").alias("quality"))
    resets = quality.reset_flags(series.counter_diff(s.select(DEV, "slot", "value"), keep_raw="raw_interval"),
                                 flag_before_clamp=True)
    return quality.merge_flags(a, resets)


@query
def q_gap_flag(spark, d):
    """Gap flag on the dense grid of raw means (existing anomaly flags win)."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    g = pl.gridded(inp).withColumnRenamed("anomaly", "quality")
    return quality.gap_flag(g, (DEV,), "slot", "accumulated", step_minutes=inp.rules.minutes).select(DEV, "slot", "accumulated", "quality")


@query
def q_missing_flag(spark, d):
    """Gap flag, first slot cleared, then 'Missing' where value and flag are both absent."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    g = pl.gridded(inp).withColumnRenamed("anomaly", "quality")
    x = quality.gap_flag(g, (DEV,), "slot", "accumulated", step_minutes=inp.rules.minutes)
    x = quality.missing_flag(quality.null_first_slot(x, first=inp.first_slot()), "accumulated")
    return x.select(DEV, "slot", "quality")


@query
def q_station_quality(spark, d):
    """Station period flags on the hourly table."""
    inp = _inp(spark, d, with_satellite=False)
    h = pl.with_stations(inp, pl.gauge_hours(inp.readings))
    return h.select("datehour", "quality_sta", "quality_stb")


@query
def q_official_quality(spark, d):
    """Official series on its calendar with trace / before-start / missing flags."""
    o = pl.official_series(fx.official_export(spark, d), fx.ORDER_PERIOD.official_year)
    return pl.official_quality(spark, o, fx.ORDER_PERIOD)


# ------------------------------------------------------------------ records / weather
@query
def q_clean_records(spark, d):
    """The published incident record table."""
    return records.clean_records(pl.parsed_incidents(fx.incident_export(spark, d)))


@query
def q_daily_weather(spark, d):
    """Daily station roll-up: max of hi, min of low, sum of rain, mean of the rest."""
    return pl.daily_weather(_inp(spark, d, with_satellite=False))


@query
def q_weather_long(spark, d):
    """Hourly station table without gauge and text columns, unpivoted to (time, field, value)."""
    return pl.weather_long(_inp(spark, d, with_satellite=False))


@query
def q_display_dates(spark, d):
    """Reading times as 'dd/MM/yyyy HH:mm' text."""
    r = fx.readings(spark, d)
    return r.select(DEV, "ts", F.date_format("ts", "dd/MM/yyyy HH:mm").alias("ts_text"))


# ------------------------------------------------------------------ coverage
@query
def q_monthly_day_count(spark, d):
    """Days with known daily rain per month and gauge."""
    inp, daily = _daily(spark, d)
    wide = reshape.pivot(daily, ["date"], DEV, inp.device_list(), {"": F.first("interval")})
    long = reshape.unpivot(wide, ["date"], DEV, "rain")
    return coverage.monthly_day_count(long)


@query
def q_bin_availability(spark, d):
    """Known values per anchored 8-hour bin, day and gauge, with a yes/no."""
    return pl.bins(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))


@query
def q_month_coverage(spark, d):
    """Usable days (more than one 8-h bin with data) per gauge and month, and percent."""
    return pl.month_coverage(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))


@query
def q_device_completeness(spark, d):
    """Per gauge: expected readings (days x 96), readings present, percent."""
    return pl.device_completeness(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))


@query
def q_column_completeness(spark, d):
    """One row: percent of calendar days with each daily series, and without station flags."""
    inp = _inp(spark, d)
    t = pl.hydro_daily(spark, inp, with_flags=True)
    rain = {c.replace("rain_", "pct_"): c for c in t.columns
            if c.startswith("rain_") and not c.startswith("rain_max")}
    return coverage.column_completeness(t, rain, {"pct_sta": "quality_sta", "pct_stb": "quality_stb"})


@query
def q_frequency_table(spark, d):
    """Per gauge: each interval value with count, percent and running totals; values are
    counted as they are and rounded for display only."""
    inp = _inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False)
    return coverage.frequency_table(pl.gridded(inp), (DEV,), "interval")


@query
def q_ingest_slots(spark, d):
    """Overlapping gauge exports of both kinds through the one-pass ingest: union, time
    parsing, repeated rows, slot means and flags, and the number of readings of a slot."""
    return pl.ingest(pl.export_readings(fx.gauge_exports(spark, d)), RULES, pl.EXPORT_ROW)


@query
def q_reading_counts(spark, d):
    """Readings of the exports, those without a time, those outside the calendar."""
    ingested = pl.ingest(pl.export_readings(fx.gauge_exports(spark, d)), RULES, pl.EXPORT_ROW)
    return pl.reading_counts(ingested, fx.COUNT_PERIOD)


@query
def q_slot_runs(spark, d):
    """Runs of consecutive slots with a known amount, by gauge and day."""
    return pl.known_runs(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))


@query
def q_reading_gaps(spark, d):
    """Stretches without a raw mean between a gauge's first and last one."""
    return pl.reading_gaps(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))


@query
def q_published_daily(spark, d):
    """The stand-in inputs written as export files (gauges of both kinds, incidents,
    stations with two-line headers, official, satellite), read by a layout, published, and
    the daily table read back by the manifest."""
    root = f"{shared_folder(spark)}/pluvio-published/{uuid.uuid4().hex}"
    layout = fx.write_exports(spark, d, f"{root}/exports")
    out = publish.from_exports(spark, layout, rules=RULES, period=fx.PERIOD)
    names = ("hydro_incident_daily", "gauge_days", "reading_counts")
    publish.write({n: out[n] for n in names}, f"{root}/tables", "first")
    return writers.read_published(spark, f"{root}/tables", "hydro_incident_daily").drop("month")


# ------------------------------------------------------------------ geo
def _polys(spark, d):
    return geo.polygon_edges(fx.polygon_vertices(spark, d))


@query
def q_lookup_fallback(spark, d):
    """Reported camp corrected through the name map, original kept where unmapped."""
    p = fx.points(spark, d)
    return geo.lookup_with_fallback(p, fx.camp_name_map(spark, d), "camp", out="camp_name_reported")


@query
def q_geo_inside(spark, d):
    """Per point: number of polygons containing it and inside/outside status."""
    return geo.count_within(fx.points(spark, d), _polys(spark, d), "point_id")


@query
def q_geo_join(spark, d):
    """Points left-joined to every containing polygon (fan-out on overlaps)."""
    j = geo.locate(fx.points(spark, d), _polys(spark, d), "point_id", out="camp_name_gps")
    return j.select("point_id", "camp_name_gps")


@query
def q_geo_consistency(spark, d):
    """Reported camp vs located camp, with location status."""
    g = pl.geo_check(fx.points(spark, d), _polys(spark, d), fx.camp_name_map(spark, d))
    return g.select("point_id", "location_status", "camp_name_reported", "camp_name_gps",
                    "camp_consistency")


# ------------------------------------------------------------------ published tables
@query
def q_hydro_daily(spark, d):
    """Flagship: the daily hydro-incident table on the reporting calendar."""
    return pl.hydro_daily(spark, _inp(spark, d))


@query
def q_subhourly(spark, d):
    """The sub-hourly gauge table: cumulative mean, interval and flag per gauge."""
    return pl.subhourly(_inp(spark, d, with_stations=False, with_incidents=False, with_satellite=False))
