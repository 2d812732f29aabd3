"""From folders of export files to the pipelines' inputs: every file kind is read as
text, its columns named alike, its values typed, and put into the schema the pipelines
take. Which files there are is a ``Layout``; all but the gauge folder are optional."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.operators import geo, records, reshape, weather
from pluvio.plans import pipelines as pl
from pluvio.sources import readers

# fixed values: file-name patterns of the two gauge export kinds, strings read as no value
# in the position check, column that holds the 6-hourly rate
FIRST_PERIOD = "*reporting*"
LATER_PERIOD = "*GSB*"
POSITION_NULLS = (*readers.DEFAULT_NULLS, "n/a")
RATE = "precipitation_rate_surface_6_hour_average"


@dataclass(frozen=True)
class Layout:
    """Paths of the exports. ``device_names`` maps a column of the later gauge files (its
    normalised name) to the device's name in the first ones; ``later_gauges`` is the folder
    of those files if it is another one. ``gauge_line_breaks``: whether
    cells of gauge files hold line breaks; a file is then one split of the scan."""
    gauges: str
    device_names: dict = field(default_factory=dict)
    gauge_line_breaks: bool = False
    later_gauges: str | None = None
    first_pattern: str = FIRST_PERIOD
    later_pattern: str = LATER_PERIOD
    incidents: str | None = None
    older_incidents: str | None = None
    older_before: str = "2020-01-01"
    lead_station: str | None = None
    other_station: str | None = None
    official: dict = field(default_factory=dict)
    chirps: str | None = None
    satellite: str | None = None
    polygons: str | None = None
    polygon_name: str = "camp_name"
    camp_names: str | None = None
    renames: str | None = None


def gauge_readings(spark: SparkSession, layout: Layout) -> DataFrame:
    """(device, ts, value, time, date) of both gauge export kinds: one reading a row (time,
    device_name, value), and one column a gauge (date, ...), which is unpivoted; columns
    without a header go. Repeated rows stay (see ``pipelines.ingest``)."""
    exports, multi = [], {"multi_line": layout.gauge_line_breaks}
    first, later = (layout.gauges, layout.first_pattern), (layout.later_gauges or layout.gauges, layout.later_pattern)
    if readers.list_files(spark, *first):
        exports.append(readers.read_folder(spark, *first, **multi).select("time", "device_name", "value"))
    if readers.list_files(spark, *later):
        wide = readers.read_folder(spark, *later, drop_unnamed=True, **multi)
        wide = wide.withColumnsRenamed(layout.device_names)
        exports.append(reshape.unpivot(wide, ["date"], "device_name", "value"))
    if not exports:
        raise FileNotFoundError(f"no gauge export in {layout.gauges}")
    text = [e.withColumn("value", F.col("value").try_cast("double")) for e in exports]
    for c in ("time", "date"):
        text = [e if c in e.columns else e.withColumn(c, F.lit(None).cast("string")) for e in text]
    return pl.export_readings(text)


def incident_records(spark: SparkSession, layout: Layout) -> DataFrame:
    """Incident records with typed dates and measures; the older extract, where there is
    one, up to ``older_before``."""
    def read(path):
        x = readers.read_delimited(spark, path)
        return pl.parsed_incidents(x.withColumns({m: F.col(m).try_cast("double") for m in records.MEASURES
                                                  if m in x.columns}))
    new = read(layout.incidents)
    if layout.older_incidents is None:
        return new
    return records.merge_periods(read(layout.older_incidents), new, layout.older_before)


def station_export(spark: SparkSession, path: str, fields) -> DataFrame:
    """A station's tab export with the date and time columns and the fields parsed later;
    a field that the file lacks is null."""
    x = readers.read_two_line_header(spark, path)
    return x.select(F.col("date").alias("x_date"), F.col("time").alias("x_time"),
                    *[F.col(c) if c in x.columns else F.lit(None).cast("string").alias(c) for c in fields])


def inputs(spark: SparkSession, layout: Layout, **kw) -> pl.Inputs:
    """The pipelines' inputs from the exports; ``kw`` are rules and periods."""
    inc = incident_records(spark, layout) if layout.incidents else None
    a = b = sat = chirps = None
    if layout.lead_station and layout.other_station:
        a, b = pl.stations(station_export(spark, layout.lead_station, weather.STATION_FIELDS),
                           station_export(spark, layout.other_station, weather.SECOND_STATION_FIELDS), inc)
    elif layout.lead_station or layout.other_station:
        raise ValueError("the weather tables take both stations or none")
    if layout.satellite:
        s = readers.read_delimited(spark, layout.satellite)
        sat = s.select("system_time_start", F.col(RATE).try_cast("double").alias("precipitation_rate"))
    if layout.chirps:
        c = readers.read_delimited(spark, layout.chirps)
        chirps = c.select("system_time_start", F.col("precipitation").try_cast("double").alias("precipitation"))
    official = {n: readers.read_delimited(spark, p).select("date", "rainfall_mm") for n, p in layout.official.items()}
    return pl.Inputs(readings=gauge_readings(spark, layout), distinct=pl.EXPORT_ROW, incidents=inc, lead_station=a, other_station=b,
                     satellite=sat, chirps=chirps, official=official or None, **kw)


def positions(spark: SparkSession, layout: Layout):
    """(points, edges, camp map) of the position check: confirmed incidents by uid."""
    x = readers.read_delimited(spark, layout.incidents, POSITION_NULLS).filter(F.col("incident") == "Yes")
    pts = x.select(F.col("uid").alias("point_id"), F.col("gps_log").try_cast("double").alias("x"),
                   F.col("gps_lat").try_cast("double").alias("y"), "camp")
    verts = readers.read_vertices(spark, layout.polygons, name=layout.polygon_name)
    return pts, geo.polygon_edges(verts), readers.read_mapping(spark, layout.camp_names)
