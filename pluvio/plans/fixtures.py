"""Stand-in inputs built from the driver tables.

Each function only spells rows in the schema a job expects (the rules of
FIXTURES.md part C); none does any of the job's work. The jobs themselves take
any data of these schemas.
"""
from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.functions.dates import ANY_DATE_FORMATS, floor_minutes
from pluvio.plans import exports
from pluvio.plans import pipelines as pl
from pluvio.session import pin

# fixed values: incident type written for each order priority
HAZARD_BY_PRIORITY = {
    "1-URGENT": "Flood", "2-HIGH": "Slope-failure", "3-MEDIUM": "Wind-Storm",
    "4-NOT SPECIFIED": "Fire", "5-LOW": "Infrastructure",
}
EVENTS_FIRST_DAY = "2024-01-01"
# the event types, which are the gauges
DEVICES = ("click", "error", "purchase", "signup", "view")
# fixed values: the columns of the tables that most stand-ins read; with them given, no job
# looks at the files of a table before it is read
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "region": "r_regionkey int, r_name string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
# rules and periods on the events calendar (January 2024); the order-date official series
# keeps its own year
RULES = pl.GaugeRules(problem_dates=("2024-01-05", "2024-01-06"), low=1.0, high=100.0)
PERIOD = pl.Period(spine_start="2024-01-01", spine_end="2024-02-05", station_start="2024-01-08",
                   station_end="2024-01-22", official_year=2024, official_start="2024-01-04")
# a calendar that ends before the readings do
COUNT_PERIOD = replace(PERIOD, spine_start="2024-01-03", spine_end="2024-01-25")
ORDER_PERIOD = replace(PERIOD, official_year=2020, official_start="2020-05-01",
                       official_spine=("2020-01-01", "2020-12-31"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    read = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark, sf_dir) -> DataFrame:
    """Gauge readings (device, ts, value): one gauge per event type; every 11th
    event id carries no value."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_type").alias("device"), "ts",
                     F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("double"))
                     .otherwise(F.col("value")).alias("value"))


def gauge_exports(spark, sf_dir) -> list[DataFrame]:
    """Gauge files as exported: two overlapping first-period extracts with a
    'time' text (y-m-d h:m:s) and one later extract with a 'date' text
    (d/m/y h:m). Together they cover every reading."""
    r = readings(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    first = r.filter(early).select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
                                   F.col("device").alias("device_name"), "value")
    overlap = r.filter(early & (F.col("ts") >= F.lit("2024-01-09").cast("timestamp_ntz"))).select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("device").alias("device_name"), "value")
    later = r.filter(~early).select(F.date_format("ts", "d/M/yyyy H:mm").alias("date"),
                                    F.col("device").alias("device_name"), "value")
    return [first, overlap, later]


def _hazard(col) -> F.Column:
    expr = None
    for k, v in HAZARD_BY_PRIORITY.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr


def incident_export(spark, sf_dir) -> DataFrame:
    """Incident records as exported (dates as day-first text): one record per
    line item, dated onto the events calendar by order key; missing incident
    dates on every 17th order, missing counts on every 13th, 19th and 23rd; free-text and
    bookkeeping columns as the export has them."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    k, line = F.col("o_orderkey"), F.col("l_linenumber")
    day = F.date_add(F.lit(EVENTS_FIRST_DAY).cast("date"), (k % 36).cast("int"))
    return j.select(
        F.date_format(F.date_add(day, 2), "dd/MM/yyyy").alias("date_of_assessment"),
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format(day, "dd/MM/yyyy")).alias("date_of_incident"),
        F.when(F.col("o_orderstatus") == "F", "Yes").otherwise("No").alias("incident"),
        _hazard(F.col("o_orderpriority")).alias("type_of_incident"),
        F.lit(1.0).alias("number_of_incidents"),
        F.when(k % 13 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("affected_hhs"),
        (F.col("l_quantity") * 5.0).alias("affected_individuals"),
        (line % 3).cast("double").alias("casualties_ind"),
        F.when(line != 7, (line % 2).cast("double")).alias("missing_ind"),
        (line % 4).cast("double").alias("injured_ind"),
        (F.col("l_quantity") - 1.0).alias("displaced_hh"),
        F.when(k % 19 != 0, F.col("l_quantity") * 2.0).alias("displaced_ind"),
        (line * 2).cast("double").alias("partially_damaged_shelters"),
        F.when(k % 23 != 0, line.cast("double")).alias("totally_damaged_shelters"),
        (line - 1).cast("double").alias("damaged_waterpoints"),
        (F.col("l_partkey") % 5).cast("double").alias("damaged_latrines"),
        (F.col("l_suppkey") % 3).cast("double").alias("damaged_health_facilities"),
        (F.col("l_partkey") % 2).cast("double").alias("damaged_food_distribution_site"),
        F.concat(F.lit("Camp "), (F.col("o_custkey") % 25).cast("string")).alias("camp"),
        F.concat(F.lit("block "), line.cast("string")).alias("camp_other_"),
        F.col("l_returnflag").alias("location_access"),
        F.col("l_linestatus").alias("required_response_wash"),
        F.col("l_returnflag").alias("traffic_x"),
        F.col("o_orderpriority").alias("additional_comments"),
        F.col("l_linestatus").alias("incident_picture"),
        F.date_format("l_shipdate", "dd/MM/yyyy").alias("time_of_submission"),
        (F.col("l_extendedprice") / 10000.0).alias("gps_log"),
        F.col("l_tax").alias("gps_lat"),
        F.concat_ws("-", k.cast("string"), F.col("l_linenumber").cast("string")).alias("uid"),
        F.concat(F.lit("org"), F.col("l_suppkey").cast("string")).alias("organization"),
    )


def station_export(spark, sf_dir, parity: int, hours_behind: int = 0) -> DataFrame:
    """A weather-station export (all text, 12-hour clock like '3:00 p',
    '---' where an hour has fewer than 3 readings for the high, '------' for the
    pressure of single-reading hours): one row per hour from the events of the
    users with the given parity. ``hours_behind`` writes the clock that much late."""
    return _export_text(_station_hours(spark, sf_dir).filter(F.col("parity") == parity), hours_behind)


def _export_text(g: DataFrame, hours_behind: int) -> DataFrame:
    t = F.col("hour") - F.make_dt_interval(F.lit(0), F.lit(hours_behind))
    s = lambda c: F.col(c).cast("string")
    return g.select(
        F.date_format(t, "M/d/yy").alias("x_date"),
        F.concat(F.date_format(t, "h:mm"), F.lit(" "),
                 F.lower(F.substring(F.date_format(t, "a"), 1, 1))).alias("x_time"),
        s("temp_out").alias("temp_out"),
        F.when(F.col("n") < 3, "---").otherwise(s("hi")).alias("hi_temp"),
        s("low_temp").alias("low_temp"),
        s("n").alias("wind_speed"),
        F.col("wind_dir"), s("hi_speed").alias("hi_speed"), F.col("hi_dir"),
        F.when(F.col("n") < 2, "------").otherwise(s("bar")).alias("bar"),
        s("rain").alias("rain"), s("rain_rate").alias("rain_rate"),
        s("hi_solar_rad").alias("hi_solar_rad"), s("uv_index").alias("uv_index"),
    )


def station_exports(spark, sf_dir, hours_behind=(0, 12)) -> list[DataFrame]:
    """Both station exports from ONE aggregation of the events, pinned, so the
    large table is scanned once for the two stand-ins."""
    hours = pin(_station_hours(spark, sf_dir))
    return [_export_text(hours.filter(F.col("parity") == p), hours_behind[p]) for p in (0, 1)]


def _station_hours(spark, sf_dir) -> DataFrame:
    """Hourly rows of both stations from one aggregation of the events."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy((F.col("user_id") % 2).alias("parity"), floor_minutes("ts", 60).alias("hour")).agg(
        F.avg("value").alias("temp_out"), F.max("value").alias("hi"), F.min("value").alias("low_temp"),
        F.count(F.lit(1)).alias("n"), F.concat(F.lit("dir "), F.min(F.col("user_id") % 16)).alias("wind_dir"),
        (F.max("event_id") % 40).cast("double").alias("hi_speed"),
        F.concat(F.lit("dir "), F.max(F.col("user_id") % 16)).alias("hi_dir"),
        (F.max("value") * 2.0).alias("hi_solar_rad"), (F.min("value") / 50.0).alias("uv_index"),
        F.avg("user_id").alias("bar"), (F.sum("value") / 100.0).alias("rain"),
        (F.max("value") / 100.0).alias("rain_rate"))


def satellite_export(spark, sf_dir) -> DataFrame:
    """6-hourly satellite rain-rate rows (date text, rate): one per reading, the dates in
    all the formats that the parser knows, by minute."""
    r = readings(spark, sf_dir)
    text = None
    for i, fmt in enumerate(ANY_DATE_FORMATS):
        spelt, turn = F.date_format("ts", fmt), F.minute("ts") % len(ANY_DATE_FORMATS) == i
        text = F.when(turn, spelt) if text is None else text.when(turn, spelt)
    return r.select(text.alias("system_time_start"), F.col("value").alias("precipitation_rate"))


def official_export(spark, sf_dir) -> DataFrame:
    """Official daily rain text file: dates written day-first on even order keys
    and month-first on odd ones, 'T' (trace) on every 10th key, otherwise the
    amount as text; header lines repeated inside the file every 1,000th key."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    date_txt = F.when(k % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(
        F.date_format("o_orderdate", "MM/dd/yyyy"))
    rain_txt = F.when(k % 10 == 0, "T").otherwise(F.col("o_totalprice").cast("string"))
    rows = o.select(k.alias("row_id"), date_txt.alias("date"), rain_txt.alias("rainfall_mm"))
    header = o.filter(k % 1000 == 1).select((-k).alias("row_id"), F.lit("Date").alias("date"),
                                            F.lit("Rainfall (mm)").alias("rainfall_mm"))
    return rows.unionByName(header)


def official_days(spark, sf_dir, parity: int) -> DataFrame:
    """A station's official daily rain text on the events calendar, one row per day, from
    the orders of the customers with the given parity: the day counts up to 12 are written
    month-first, later ones day-first; 'T' on days ending in 3, no amount on every
    seventh, else a quarter millimetre per order."""
    o = table(spark, sf_dir, "orders").filter(F.col("o_custkey") % 2 == parity)
    day = F.date_add(F.lit(EVENTS_FIRST_DAY).cast("date"), (F.col("o_orderkey") % 36).cast("int"))
    d = o.groupBy(day.alias("day")).agg((F.count(F.lit(1)) / 4.0).alias("mm"))
    dom = F.dayofmonth("day")
    return d.select(
        F.when(dom > 12, F.date_format("day", "dd/MM/yyyy")).otherwise(F.date_format("day", "MM/dd/yyyy")).alias("date"),
        F.when(dom % 10 == 3, "T").when(dom % 7 != 0, F.col("mm").cast("string")).alias("rainfall_mm"))


def chirps_export(spark, sf_dir) -> DataFrame:
    """Daily satellite rain already in millimetres, one row per day of the events calendar."""
    o = table(spark, sf_dir, "orders")
    day = F.date_add(F.lit(EVENTS_FIRST_DAY).cast("date"), (F.col("o_orderkey") % 36).cast("int"))
    return o.groupBy(day.alias("day")).agg((F.count(F.lit(1)) / 7.0).alias("precipitation")).select(
        F.date_format("day", "yyyy-MM-dd").alias("system_time_start"), "precipitation")


def inputs(spark: SparkSession, sf_dir: str, with_stations=True, with_incidents=True,
           with_satellite=True, checkpoint=True) -> pl.Inputs:
    """The pipelines' inputs from the stand-ins."""
    inc = pl.parsed_incidents(incident_export(spark, sf_dir)) if with_incidents else None
    a = b = sat = chirps = official = None
    if with_stations:
        a, b = pl.stations(*station_exports(spark, sf_dir, (0, 12)), inc)
    if with_satellite:
        sat, chirps = satellite_export(spark, sf_dir), chirps_export(spark, sf_dir)
        official = {"offa": official_days(spark, sf_dir, 0), "offb": official_days(spark, sf_dir, 1)}
    return pl.Inputs(readings=readings(spark, sf_dir), incidents=inc, lead_station=a, other_station=b,
                     satellite=sat, chirps=chirps, official=official, rules=RULES, period=PERIOD,
                     checkpoint=checkpoint)


def points(spark, sf_dir) -> DataFrame:
    """Reported positions: the first two embedding components, camp = label text."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("point_id"),
                    F.col("embedding")[0].cast("double").alias("x"),
                    F.col("embedding")[1].cast("double").alias("y"),
                    F.col("label").cast("string").alias("camp"))


def camp_name_map(spark, sf_dir) -> DataFrame:
    """Name corrections (old -> new): region key text -> region name."""
    r = table(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("string").alias("old_name"),
                    F.col("r_name").alias("new_name"))


def polygon_vertices(spark, sf_dir) -> DataFrame:
    """One polygon per region, placed by its key (neighbours overlap): a quadrilateral
    (ring 0) with a hole (ring 1) and an island above it (ring 2)."""
    r = table(spark, sf_dir, "region")
    x0 = F.lit(-0.4) + F.lit(0.16) * F.col("r_regionkey")
    v = lambda g, i, x, y: F.struct(F.lit(g).alias("ring_id"), F.lit(i).alias("seq"), x.alias("x"),
                                    F.lit(y).alias("y"))
    verts = F.array(v(0, 0, x0, -0.3), v(0, 1, x0 + 0.2, -0.25), v(0, 2, x0 + 0.22, 0.3), v(0, 3, x0 - 0.02, 0.25),
                    v(1, 0, x0 + 0.06, -0.05), v(1, 1, x0 + 0.12, -0.05), v(1, 2, x0 + 0.12, 0.06), v(1, 3, x0 + 0.06, 0.05),
                    v(2, 0, x0 + 0.01, 0.31), v(2, 1, x0 + 0.1, 0.31), v(2, 2, x0 + 0.1, 0.39), v(2, 3, x0 + 0.01, 0.38))
    return r.select(F.col("r_name").alias("name"), F.explode(verts).alias("v")).select(
        "name", "v.ring_id", "v.seq", "v.x", "v.y")


# --------------------------------------------------------------------------- as files
def later_gauges_wide(spark, sf_dir) -> DataFrame:
    """The later gauge kind as its files have it: a row a minute with a reading, a column a
    gauge with the largest value of the minute."""
    later = gauge_exports(spark, sf_dir)[2]
    return later.groupBy("date").pivot("device_name", DEVICES).agg(F.max("value"))


def _two_line_station(export: DataFrame) -> DataFrame:
    """Lines of a station's tab file: two header lines, the first word of a column's name
    over the rest of it, then the rows."""
    names = ["date", "time", *[c for c in export.columns if c not in ("x_date", "x_time")]]
    over = [n.split("_", 1)[0].title() if "_" in n else "" for n in names]
    under = [n.split("_", 1)[-1].replace("_", " ").title() for n in names]
    head = export.sparkSession.createDataFrame([(0, "\t".join(over)), (1, "\t".join(under))], "n int, line string")
    body = export.select(F.lit(2), F.concat_ws("\t", *[F.coalesce(F.col(c), F.lit("")) for c in export.columns]))
    return head.union(body).coalesce(1).sortWithinPartitions("n").select("line")


def write_exports(spark, sf_dir, root: str) -> exports.Layout:
    """The stand-in inputs as export files under ``root``."""
    def csv(df, name, mode="errorifexists"):
        df.write.mode(mode).option("header", True).csv(f"{root}/{name}")
        return f"{root}/{name}"
    first, overlap, _ = gauge_exports(spark, sf_dir)
    csv(first, "gauges")
    stations = []
    for name, parity, behind in (("lead", 0, 0), ("other", 1, 12)):
        _two_line_station(station_export(spark, sf_dir, parity, behind)).write.text(f"{root}/{name}")
        stations.append(f"{root}/{name}")
    return exports.Layout(
        gauges=csv(overlap, "gauges", "append"), later_gauges=csv(later_gauges_wide(spark, sf_dir), "later"),
        first_pattern="*.csv", later_pattern="*.csv", incidents=csv(incident_export(spark, sf_dir), "incidents"),
        lead_station=stations[0], other_station=stations[1],
        official={n: csv(official_days(spark, sf_dir, p), n) for p, n in enumerate(("offa", "offb"))},
        chirps=csv(chirps_export(spark, sf_dir), "chirps"),
        satellite=csv(satellite_export(spark, sf_dir).withColumnRenamed("precipitation_rate", exports.RATE), "satellite"))
