"""Pipelines: the published tables composed from the operators.

The gauge side starts with ONE aggregation of the raw readings into
(device, 15-minute slot) — raw mean, corrected mean, anomaly flag and the number of
readings together — so the large input is scanned and shuffled once; every later step,
the counts of rejected readings and the hours of the weather table included, works on
that slot table, whose size is devices x time span, not the number of readings. Repeated
rows of export files go within the same shuffle.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions import exact
from pluvio.functions.dates import any_date, day_month_ambiguous, floor_minutes, ntz_literal, parse_timestamp, slot_start
from pluvio.functions.nulls import r_if_else, round_half
from pluvio.operators import columns, coverage, geo, quality, records, reshape, runs, series, weather
from pluvio.operators.quality import ANOMALY_TEXT, RESET_TEXT, TRACE_TEXT
from pluvio.session import pin, stored
from pluvio.sources.generated import calendar

DEV = "device"


UNKNOWN_DEVICE = "unknown"
# groups that readings without a time, which only are counted, are spread over
UNTIMED_GROUPS = 1024


@dataclass(frozen=True)
class GaugeRules:
    """Gauge rules. Defaults are the fixed values of the source pipeline: the three
    days whose readings were checked by hand, the plausibility bounds of those
    days (the code's 100000, not the 10000 of its comment), 15-minute slots,
    a 12-slot (3-hour) rolling window, reset flags tested after the clamp."""
    problem_dates: tuple = ("2020-04-29", "2020-04-30", "2020-05-03")
    low: float = 10.0
    high: float = 100000.0
    minutes: int = 15
    rolling_width: int = 12
    flag_before_clamp: bool = False

    def __post_init__(self):
        series.check_step(self.minutes)


@dataclass(frozen=True)
class Period:
    """Reporting periods. Defaults are the fixed values of the source pipeline:
    the 2020 reporting calendar, the stations' operating period, the official
    series' year and first reported day."""
    spine_start: str = "2020-01-01"
    spine_end: str = "2020-11-30"
    station_start: str = "2020-06-09"
    station_end: str = "2020-09-22"
    official_year: int = 2020
    official_start: str = "2020-05-01"
    official_spine: tuple = ("2020-01-01", "2020-11-30")


@dataclass
class Inputs:
    """Logical inputs of the pipelines (any data of these schemas). ``distinct`` names the
    columns of ``readings`` by which a row is a repeated one; none if no row repeats."""
    readings: DataFrame
    distinct: tuple = ()
    incidents: DataFrame | None = None
    lead_station: DataFrame | None = None
    other_station: DataFrame | None = None
    satellite: DataFrame | None = None
    chirps: DataFrame | None = None
    official: dict | None = None          # {name: official export}, e.g. two stations
    devices: list | None = None
    rules: GaugeRules = field(default_factory=GaugeRules)
    period: Period = field(default_factory=Period)
    checkpoint: bool = True
    _ingested: DataFrame | None = field(default=None, repr=False)
    _known: tuple | None = field(default=None, repr=False)

    def ingested(self) -> DataFrame:
        """What one pass over the readings gives (see ``ingest``), computed once. With
        ``checkpoint`` it is written to the shared folder as a table laid out by gauge and
        day and partitioned by month (``session.stored``): every consumer (grid bounds,
        device names, differences, flags, counts) reads that small table instead of
        re-running the aggregation of the readings, differences, grid and rolling sums
        follow without another exchange, and a lost executor costs a re-read."""
        if self._ingested is None:
            s = ingest(self.readings, self.rules, self.distinct).withColumn("date", F.to_date("slot"))
            if self.checkpoint:
                s = stored(s.withColumn("month", F.date_format("date", "yyyy-MM")), (DEV, "date"), ("slot",), "month")
            self._ingested = s
        return self._ingested

    def slots(self) -> DataFrame:
        return slots_of(self.ingested())

    def _summary(self) -> tuple:
        """(first slot, last slot, devices), read in one aggregation; no devices where there
        are more than can be columns, of which one row a device is read at most."""
        if self._known is None:
            per = self.slots().groupBy(DEV).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
            most = reshape.MAX_PIVOT_VALUES
            found = per.limit(most + 1).collect()
            if len(found) <= most:
                lo, hi = min((r["lo"] for r in found), default=None), max((r["hi"] for r in found), default=None)
                self._known = (lo, hi, sorted(r[DEV] for r in found), len(found))
            else:
                r = per.agg(F.min("lo"), F.max("hi"), F.count(F.lit(1))).first()
                self._known = (r[0], r[1], None, r[2])
        return self._known

    def device_list(self) -> list:
        if self.devices is not None:
            return list(self.devices)
        found = self._summary()[2]
        if found is None:
            raise ValueError(f"{DEV}: {self._summary()[3]} values, more than {reshape.MAX_PIVOT_VALUES} to pivot")
        return list(found)

    def can_pivot(self) -> bool:
        return self.devices is not None or self._summary()[2] is not None

    def bounds(self) -> tuple:
        """(first slot, last slot) of the slot table."""
        return self._summary()[:2]

    def first_slot(self):
        return ntz_literal(self.bounds()[0])

    def last_day(self):
        hi = self.bounds()[1]
        return None if hi is None else hi.date()


# --------------------------------------------------------------------------- gauges
def ingest(readings: DataFrame, rules: GaugeRules, distinct=()) -> DataFrame:
    """(device, slot, accumulated, value, anomaly, readings): raw mean, mean after anomaly
    masking, anomaly flag and number of the readings of each slot, from one aggregation;
    readings without a time are counted in rows without a slot. Means don't depend on the
    order of the readings.

    With ``distinct``, rows alike in these columns and the device count once. Rows that
    are alike lie in one slot, so the readings are dealt out by slot once and both the
    repeated rows and the means are seen to where they then are."""
    cond = quality.anomaly_condition("ts", "value", rules.problem_dates, rules.low, rules.high)
    x = readings.withColumns({
        # a reading without a device is a series of its own, in long and wide tables alike;
        # a device of that name gets another one
        DEV: (F.when(F.col(DEV).isNull(), F.lit(UNKNOWN_DEVICE))
              .when(F.col(DEV).rlike(f"^{UNKNOWN_DEVICE}_*$"), F.concat(F.col(DEV), F.lit("_"))).otherwise(F.col(DEV))),
        "slot": slot_start("ts", rules.minutes),
        "masked": r_if_else(cond, F.lit(None).cast("double"), F.col("value")),
        "flagged": F.when(cond, 1),
        "group": F.when(F.col("ts").isNull(), F.pmod(F.hash(*readings.columns), F.lit(UNTIMED_GROUPS))).otherwise(0)})
    keys = (DEV, "slot", "group")
    if distinct:
        x = x.repartition(*keys).dropDuplicates([*keys, *[c for c in distinct if c not in keys]])
    s = series.summarised(x, keys, {"accumulated": "value", "value": "masked"},
                          {"anomaly": F.max("flagged"), "readings": F.count(F.lit(1))})
    # the flag is a number inside the aggregation, which so stays a hash aggregation
    return s.drop("group").withColumn("anomaly", F.when(F.col("anomaly") == 1, ANOMALY_TEXT))


def slots_of(ingested: DataFrame) -> DataFrame:
    """(device, slot, accumulated, value, anomaly), and date where it is known."""
    return ingested.filter(F.col("slot").isNotNull()).drop("readings", "month")


def slot_table(readings: DataFrame, rules: GaugeRules, distinct=()) -> DataFrame:
    return slots_of(ingest(readings, rules, distinct))


def reading_counts(ingested: DataFrame, period: Period) -> DataFrame:
    """One row: readings, those that no slot can take because their time is null
    (unparsable text), and those with a time outside the reporting period, which widen
    every dense table. Published with the tables, so a wrong format or clock shows."""
    day, n = F.to_date("slot"), F.col("readings")
    outside = (day < F.lit(period.spine_start).cast("date")) | (day > F.lit(period.spine_end).cast("date"))
    total = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0)).cast("bigint")
    return ingested.agg(total(F.lit(True)).alias("readings"), total(F.col("slot").isNull()).alias("without_time"),
                        total(outside).alias("outside_period"))


def rejected_readings(readings: DataFrame) -> DataFrame:
    """One row: readings, and those without a time, counted from the readings themselves."""
    return readings.agg(F.count(F.lit(1)).alias("readings"), F.count_if(F.col("ts").isNull()).alias("without_time"))


def gridded(inp: Inputs) -> DataFrame:
    """The slot table on its dense grid with the counter differences:
    (device, slot, date, accumulated, value, anomaly, interval, raw_interval)."""
    diffs = series.counter_diff(inp.slots(), (DEV,), "slot", "value", "interval", clamp=True,
                                keep_raw="raw_interval", day="date")
    g = series.densify(diffs, (DEV,), "slot", inp.rules.minutes, bounds=inp.bounds(), day="date")
    return g.select(DEV, "slot", "date", "accumulated", "value", "anomaly", "interval", "raw_interval")


def rolled(g: DataFrame, rules: GaugeRules, last_day=None) -> DataFrame:
    """Grid without its last (partial) day, plus the 3-hour full-window sum."""
    d = series.drop_last_day(g, last_day=last_day)
    return series.rolling_full_window_sum(d, "interval", "max_3_hour", (DEV,), "slot", rules.rolling_width)


def daily_rain_wide(daily: DataFrame, devices) -> DataFrame:
    return reshape.pivot(daily, ["date"], DEV, devices,
                         {"rain": F.first("interval"), "rain_max_3h": F.first("max_3_hr_interval")})


def subhourly_long(inp: Inputs, g: DataFrame | None = None) -> DataFrame:
    """Per slot and device the raw cumulative mean, the interval amount and one flag —
    anomaly / counter reset (smallest text), else a gap after an empty slot; the first
    slot carries none; 'Missing' where neither value nor flag exists."""
    g = gridded(inp) if g is None else g
    reset_col = "raw_interval" if inp.rules.flag_before_clamp else "interval"
    q = F.least(F.col("anomaly"), F.when(F.col(reset_col) < 0, F.lit(RESET_TEXT)))
    x = g.withColumn("quality", q)
    x = quality.gap_flag(x, (DEV,), "slot", "accumulated", "quality", step_minutes=inp.rules.minutes, day="date")
    x = quality.null_first_slot(x, "slot", "quality", first=inp.first_slot())
    return quality.missing_flag(x, "accumulated", "quality").select(DEV, "slot", "accumulated", "interval", "quality")


def subhourly(inp: Inputs, g: DataFrame | None = None) -> DataFrame:
    """The sub-hourly gauge table, one row per slot with three columns a gauge."""
    x = subhourly_long(inp, g)
    devs = inp.device_list()
    wide = reshape.pivot(x, ["slot"], DEV, devs, {
        "cumulative_rain": F.first("accumulated"), "quality": F.first("quality"),
        "rain": F.first("interval")})
    layout = ["slot"] + [f"{m}_{d}" for m in ("cumulative_rain", "quality", "rain") for d in devs]
    return columns.keep_existing(wide, layout).withColumnRenamed("slot", "date_time")


# --------------------------------------------------------------------------- side series
def satellite_daily(sat: DataFrame, date_col="system_time_start", rate="precipitation_rate",
                    name="rain_cfsr") -> DataFrame:
    """6-hourly rate -> daily mm: rate x (1/0.997) x 21600 summed per day, 0 when
    no value, two decimals. The day's sum does not depend on the order Spark adds the
    terms in, so neither does the rounded figure."""
    mm = F.col(rate) * (1 / 0.997) * 60 * 60 * 6
    d = exact.with_totals(sat.select(any_date(date_col).alias("date"), mm.alias("_mm")).groupBy("date").agg(*exact.sums("_mm", name)), name)
    return d.select("date", F.round(F.coalesce(name, F.lit(0.0)), 2).alias(name))


def chirps_daily(export: DataFrame, date_col="system_time_start", value="precipitation",
                 name="rain_chirps") -> DataFrame:
    """Daily satellite rain already in mm: free-form date text, value at two decimals."""
    return export.select(any_date(date_col).alias("date"), round_half(value, 2).alias(name))


def official_series(export: DataFrame, year: int, name: str = "official",
                    date_col="date", rain_col="rainfall_mm") -> DataFrame:
    """Official daily rain text -> ([row_id,] date, rain_<name>, quality_<name>):
    repeated header rows and empty rows out, day/month order guessed, 'T' read as
    0.5 mm with a 'Trace' flag, other text as a number."""
    d, r = F.col(date_col), F.col(rain_col)
    x = export.filter(~F.coalesce(d.isin("Date"), F.lit(False)) & d.isNotNull() & r.isNotNull())
    row_id = ["row_id"] if "row_id" in export.columns else []
    return x.select(*row_id, F.col(date_col).alias("date_text"),
                    day_month_ambiguous(d, year).alias("date"),
                    F.when(r == "T", F.lit(0.5)).otherwise((r).try_cast("double")).alias(f"rain_{name}"),
                    F.when(r == "T", F.lit(TRACE_TEXT)).alias(f"quality_{name}"))


def official_quality(spark: SparkSession, official: DataFrame, period: Period, name="official"):
    days = calendar(spark, *period.official_spine)
    j = days.join(official.drop("row_id", "date_text"), on="date", how="left")
    return j.withColumn(f"quality_{name}", quality.official_flag(
        "date", f"rain_{name}", f"quality_{name}", period.official_start))


# --------------------------------------------------------------------------- stations
def stations(lead_export: DataFrame, other_export: DataFrame, incidents: DataFrame | None = None,
             other_shift_hours: int = 12):
    """Both station exports parsed (the second one's clock is 12 h late), each cut at
    the latest published incident date when incidents are given."""
    a = weather.parse_station(lead_export, {c: c for c in weather.STATION_FIELDS}, "sta_")
    b = weather.parse_station(other_export, {c: c for c in weather.SECOND_STATION_FIELDS}, "stb_",
                              shift_hours=other_shift_hours)
    if incidents is not None:
        pub = published_incidents(incidents)
        a = weather.cut_after(a, "time_date", pub, "date_of_incident")
        b = weather.cut_after(b, "time_date", pub, "date_of_incident")
    return a, b


def hourly_table(inp: Inputs, r: DataFrame | None = None) -> DataFrame:
    """Hourly gauge sums (wide, precip_<device>) joined to both stations by hour,
    with station period flags."""
    r = rolled(gridded(inp), inp.rules, inp.last_day()) if r is None else r
    return with_stations(inp, hourly_gauges(inp, r))


def hourly_gauges(inp: Inputs, r: DataFrame) -> DataFrame:
    """Hourly gauge sums, one column a gauge."""
    h = series.hourly_sum(r, (DEV,), "slot", "interval", "precipitation")
    devs = inp.device_list()
    wide = reshape.pivot(h, ["datehour"], DEV, devs, {"": F.first("precipitation")})
    return wide.withColumnsRenamed({str(d): f"precip_{d}" for d in devs})


def with_stations(inp: Inputs, hours: DataFrame) -> DataFrame:
    """``hours`` (datehour, ...) joined to both stations, with station period flags."""
    p = inp.period
    return weather.hourly_weather(hours, inp.lead_station, inp.other_station, p.station_start,
                                  p.station_end, "sta_low_temp", "stb_hi_temp",
                                  lead_flag="quality_sta", other_flag="quality_stb")


def gauge_hours(readings: DataFrame) -> DataFrame:
    """The hours (datehour) of the gauges' grid without its last day, from the first and
    the last reading time alone."""
    return _hours(readings.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")))


def grid_hours(inp: Inputs) -> DataFrame:
    """The same from the bounds of the slot table: the readings aren't read for it."""
    lo, hi = inp.bounds()
    one = inp.readings.sparkSession.range(1)
    return _hours(one.select(ntz_literal(lo).alias("lo"), ntz_literal(hi).alias("hi")))


def _hours(ends: DataFrame) -> DataFrame:
    x = ends.select(floor_minutes("lo", 60).alias("first"), F.to_date("hi").cast("timestamp_ntz").alias("end"))
    hour = F.make_dt_interval(F.lit(0), F.lit(1))
    return x.filter(F.col("first") < F.col("end")).select(
        F.explode(F.sequence("first", F.col("end") - hour, hour)).alias("datehour"))


def weather_long(inp: Inputs, hours: DataFrame | None = None) -> DataFrame:
    """The stations' numeric fields on the gauges' hours as (datehour, weather_field, value)."""
    h = columns.drop_strings(with_stations(inp, gauge_hours(inp.readings) if hours is None else hours))
    return reshape.unpivot(h, ["datehour"], "weather_field", "value")


def daily_weather(inp: Inputs) -> DataFrame:
    return weather.daily_weather(inp.lead_station, inp.other_station, drop=("sta_bar",))


# --------------------------------------------------------------------------- incidents
def parsed_incidents(export: DataFrame) -> DataFrame:
    return records.parse_incident_dates(export)


def published_incidents(parsed: DataFrame) -> DataFrame:
    return records.reported_incidents(parsed).filter(F.col("type_of_incident").isin(
        [*records.HAZARDS, *records.PUBLISHED_EXTRA_TYPES]))


def incident_daily(parsed: DataFrame, measures=records.MEASURES) -> DataFrame:
    return records.incident_pivot(records.reported_incidents(parsed), measures)


# --------------------------------------------------------------------------- flagship
# fixed values: station columns left out of the published daily table
DAILY_DROPPED = ("sta_rain_rate", "stb_rain_rate")


def hydro_daily(spark: SparkSession, inp: Inputs, with_flags: bool = False,
                measures=records.PUBLISHED_MEASURES, drop=DAILY_DROPPED, r: DataFrame | None = None) -> DataFrame:
    """The daily hydro-incident table on the reporting calendar: per-gauge daily
    rain and largest 3-hour sum, full-joined with the daily incident pivot, hazard
    totals, the official series with their flags, daily satellite rain (CHIRPS,
    6-hourly rate), the daily weather roll-up (without the stations' rain-rate
    columns) and (``with_flags``) the station period flags. Every source except the
    readings is optional."""
    r = rolled(gridded(inp), inp.rules, inp.last_day()) if r is None else r
    d = series.daily_rain(r, (DEV,))
    full = daily_rain_wide(d, inp.device_list())
    if inp.incidents is not None:
        full = full.join(incident_daily(inp.incidents, measures), on="date", how="full")
    p = inp.period
    out = calendar(spark, p.spine_start, p.spine_end).join(full, on="date", how="left")
    if inp.incidents is not None:
        out = records.hazard_totals(out, measures)
    if inp.official:
        for name, export in inp.official.items():
            o = official_series(export, p.official_year, name).drop("row_id", "date_text")
            out = out.join(o, on="date", how="left").withColumn(
                f"quality_{name}", quality.official_flag("date", f"rain_{name}", f"quality_{name}",
                                                         p.official_start))
    if inp.chirps is not None:
        out = out.join(chirps_daily(inp.chirps), on="date", how="left")
    if inp.satellite is not None:
        out = out.join(satellite_daily(inp.satellite), on="date", how="left")
    if inp.lead_station is not None:
        out = out.join(daily_weather(inp).drop(*drop), on="date", how="left")
        if with_flags:
            out = weather.station_daily_flags(out, p.station_start, p.station_end, {
                "quality_sta": "sta_low_temp", "quality_stb": "stb_hi_temp"})
    return published_order(out, inp.device_list(), measures)


def published_order(daily: DataFrame, devices, measures, hazards=records.HAZARDS) -> DataFrame:
    """The daily table's published layout: the listed columns that exist (sources
    are optional), in the published order, then every other column."""
    official = sorted(c[len("quality_"):] for c in daily.columns
                      if c.startswith("quality_") and f"rain_{c[len('quality_'):]}" in daily.columns)
    wanted = (["date"] + [f"rain_{d}" for d in devices] + [f"rain_max_3h_{d}" for d in devices]
              + [c for n in official for c in (f"rain_{n}", f"quality_{n}")] + ["rain_chirps", "rain_cfsr"])
    for m in measures:
        wanted += [f"total_{m}"] + [f"{m}_{h}" for h in hazards]
    for st in ("sta", "stb"):
        wanted += [f"quality_{st}"] + sorted(c for c in daily.columns if c.startswith(f"{st}_"))
    return columns.keep_existing(daily, wanted + [c for c in daily.columns if c not in wanted])


# --------------------------------------------------------------------------- coverage
def known_runs(inp: Inputs) -> DataFrame:
    """``runs.day_runs`` of the slots with a known amount, without the last (partial) day.
    No dense grid is made for it."""
    diffs = series.counter_diff(inp.slots(), (DEV,), "slot", "value", "interval", clamp=True, day="date")
    r = runs.day_runs(diffs, (DEV,), "slot", inp.rules.minutes, "interval", "date")
    return r.filter(F.col("date") < F.lit(inp.last_day()))


def devices_of(inp: Inputs) -> DataFrame:
    return inp.slots().select(DEV).distinct()


def _span(inp: Inputs) -> tuple:
    return inp.bounds()[0], inp.last_day()


def bins(inp: Inputs, known: DataFrame | None = None, minutes: int = 480) -> DataFrame:
    """Count of known amounts per bin of ``minutes`` (from the first slot on), day and
    gauge, with a yes/no, for every bin of the grid without its last day."""
    known = known_runs(inp) if known is None else known
    first, end = _span(inp)
    n = runs.bin_counts(known, ntz_literal(first), (DEV,), inp.rules.minutes, minutes)
    every = runs.all_bins(devices_of(inp), first, end, (DEV,), inp.rules.minutes, minutes)
    return (every.join(n, on=[DEV, "date", "bin_start"], how="left")
            .select("bin_start", "date", DEV, F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
            .withColumn("available", F.when(F.col("count") > 0, "yes").otherwise("no")))


def month_coverage(inp: Inputs, known: DataFrame | None = None, minutes: int = 480, min_bins: int = 1) -> DataFrame:
    """Usable days per gauge and month, from the runs of known amounts."""
    known = known_runs(inp) if known is None else known
    first, end = _span(inp)
    usable = runs.usable_days(runs.bin_counts(known, ntz_literal(first), (DEV,), inp.rules.minutes, minutes), (DEV,), min_bins)
    return runs.month_coverage(usable, devices_of(inp), first, end, (DEV,))


def device_completeness(inp: Inputs, known: DataFrame | None = None) -> DataFrame:
    """Slots expected and present per gauge, by the rules' slot length."""
    known = known_runs(inp) if known is None else known
    return runs.completeness(known, devices_of(inp), *_span(inp), (DEV,), inp.rules.minutes)


def reading_gaps(inp: Inputs) -> DataFrame:
    """(device, gap_first, gap_last, slots): the stretches without a raw mean between a
    gauge's first and last one."""
    by_day = runs.day_runs(inp.slots(), (DEV,), "slot", inp.rules.minutes, "accumulated", "date")
    return runs.gaps(runs.series_runs(by_day, (DEV,), inp.rules.minutes), (DEV,), inp.rules.minutes)


def gauge_union(exports) -> DataFrame:
    """Gauge exports unioned by name with the two time spellings parsed into one
    timestamp, ``date_time``; repeated rows stay."""
    u = exports[0]
    for e in exports[1:]:
        u = u.unionByName(e, allowMissingColumns=True)
    t = F.when(F.col("date").isNull(), parse_timestamp("time", "yyyy-MM-dd HH:mm:ss")).otherwise(
        parse_timestamp("date", "d/M/yyyy H:mm"))
    return u.withColumn("date_time", t)


#: Columns of a gauge export by which a row is a repeated one
EXPORT_ROW = ("time", "date", "value")


def export_readings(exports) -> DataFrame:
    """(device, ts, value, time, date) of gauge exports, repeated rows included: they go
    in ``ingest`` by ``EXPORT_ROW``."""
    return gauge_union(exports).select(F.col("device_name").alias(DEV), F.col("date_time").alias("ts"), "value", "time", "date")


def gauge_ingest(exports) -> DataFrame:
    """Gauge exports unioned by name, whole-row duplicates removed, the two time
    spellings parsed into one timestamp."""
    u = gauge_union(exports)
    return u.dropDuplicates([c for c in u.columns if c != "date_time"]).drop("time", "date")


def geo_check(points: DataFrame, edges: DataFrame, camp_map: DataFrame, band: float | None = None):
    """Incidents with a GPS check: reported camp corrected through the map (else
    kept), points with both coordinates located in the camp polygons (one row per
    containing polygon, or one row with a null when outside), status and
    reported-vs-located consistency."""
    p = geo.lookup_with_fallback(points, camp_map, "camp", out="camp_name_reported").drop("camp")
    p = p.filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    j = geo.locate(p, edges, "point_id", "x", "y", "camp_name_gps", band)
    j = j.withColumn("location_status", F.when(F.col("camp_name_gps").isNull(), geo.OUTSIDE).otherwise(geo.INSIDE))
    return geo.consistency(j, "camp_name_reported", "camp_name_gps")
