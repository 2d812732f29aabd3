"""Publish job: the four published tables and the side tables, written under one
run folder with a manifest (``sinks.writers``). What several tables share (slot table, grid, rolled grid, parsed incidents) is
checkpointed once into the cluster's ``spark.checkpoint.dir`` (required on a cluster).

usage: python -m pluvio.plans.publish LAYOUT.json OUT_DIR RUN_DATE [--local]
LAYOUT.json holds the fields of ``exports.Layout`` and, optionally, "rules" and "period"
with those of ``pipelines.GaugeRules`` and ``Period``. (``--local``: single-machine run
without the cluster settings)
"""
from __future__ import annotations

import dataclasses
import json
import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.operators import columns, coverage, geo, quality, reshape
from pluvio.plans import exports
from pluvio.plans import fixtures as fx
from pluvio.plans import pipelines as pl
from pluvio.session import CLUSTER_CONF, get_session, pin
from pluvio.sinks import writers

# fixed values: the rename map's dataset of each published table
DATASETS = {"hydro_incident_daily": "Hydro-incident dataset", "weather_hourly": "Hourly Summary",
            "gauges_subhourly": "Field Measurements"}


def tables(spark, inp: pl.Inputs, points: DataFrame | None = None, edges: DataFrame | None = None,
           camp_map: DataFrame | None = None, renames: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every table of the inputs given. The gauges are published long (``gauge_slots``,
    ``gauge_days``) and wide in the first three tables. Where there are more than
    ``reshape.MAX_PIVOT_VALUES`` of them, those tables have no gauge columns; tables of
    their key and a group of gauges each, named after them with a number, have (see
    ``group_key``). ``renames`` (old_name, new_name, dataset) renames the published columns."""
    if inp.incidents is not None:
        inp.incidents = pin(inp.incidents)
    groups = []
    if not inp.can_pivot():
        names = sorted(r[0] for r in pl.devices_of(inp).toLocalIterator())
        most = reshape.MAX_PIVOT_VALUES
        groups = [names[i:i + most] for i in range(0, len(names), most)]
        inp.devices = []
    g = pin(pl.gridded(inp))
    r = pin(pl.rolled(g, inp.rules, inp.last_day()))
    known = pin(pl.known_runs(inp))
    out = {
        "hydro_incident_daily": writers.with_month(pl.hydro_daily(spark, inp, r=r)),
        "weather_hourly": pl.hourly_table(inp, r),
        "gauges_subhourly": pl.subhourly(inp, g),
        "gauge_slots": pl.subhourly_long(inp, g),
        "gauge_days": pl.series.daily_rain(r, (pl.DEV,)),
        "device_completeness": pl.device_completeness(inp, known),
        "month_coverage": pl.month_coverage(inp, known),
        "gauge_gaps": pl.reading_gaps(inp),
        "flagged_slots": quality.flagged_rows(inp.slots().withColumnRenamed("anomaly", "quality"), (pl.DEV,)),
        "reading_counts": pl.reading_counts(inp.ingested(), inp.period),
        "frequency": coverage.frequency_table(g, (pl.DEV,), "interval"),
    }
    for i, devices in enumerate(groups):
        own = dataclasses.replace(inp, devices=devices)
        of = lambda t: t.filter(F.col(pl.DEV).isin(devices))  # noqa: E731, B023
        out[f"hydro_incident_daily_{i:04}"] = pl.daily_rain_wide(of(out["gauge_days"]), devices)
        out[f"weather_hourly_{i:04}"] = pl.hourly_gauges(own, of(r))
        out[f"gauges_subhourly_{i:04}"] = pl.subhourly(own, of(g))
    if inp.lead_station is not None:
        out["weather_long"] = pl.weather_long(inp, pl.grid_hours(inp))
    if inp.incidents is not None:
        out["incident_records"] = pl.records.clean_records(inp.incidents)
    if points is not None:
        out["incident_gps_check"] = pl.geo_check(points, edges, camp_map)
        out["incidents_without_coordinate"] = points.filter(F.col("x").isNull())
    if renames is not None:
        for name in out:
            if dataset := DATASETS.get(_base(name)):
                out[name] = columns.rename_by_table(out[name], renames, dataset)
    return out


def _base(name: str) -> str:
    head, _, number = name.rpartition("_")
    return head if head in DATASETS and number.isdigit() else name


def group_key(name: str, table: DataFrame) -> dict:
    """What the manifest says of a table: for a group of gauges, the table it belongs to
    and the key of both, which comes first."""
    return {"of": _base(name), "key": table.columns[0]} if _base(name) != name else {}


def build(spark, sf_dir: str) -> dict[str, DataFrame]:
    """The published tables of the stand-in inputs."""
    return tables(spark, fx.inputs(spark, sf_dir), fx.points(spark, sf_dir),
                  geo.polygon_edges(fx.polygon_vertices(spark, sf_dir)), fx.camp_name_map(spark, sf_dir))


def from_exports(spark, layout: exports.Layout, **kw) -> dict[str, DataFrame]:
    """The published tables of a layout of export files."""
    where = exports.positions(spark, layout) if layout.polygons and layout.camp_names and layout.incidents else ()
    renames = exports.readers.read_mapping(spark, layout.renames) if layout.renames else None
    return tables(spark, exports.inputs(spark, layout, **kw), *where, renames=renames)


def write(out: dict[str, DataFrame], root: str, run_date: str) -> dict[str, str]:
    """Parquet per table under the run folder, the daily table by month; the position
    check also as CSV, from what was written."""
    paths = writers.publish(out, root, run_date, {"hydro_incident_daily": ["month"]}, {n: group_key(n, t) for n, t in out.items()})
    if "incident_gps_check" in paths:
        gps = out["incident_gps_check"].sparkSession.read.parquet(paths["incident_gps_check"])
        writers.write_csv(gps.withColumn("run_date", F.lit(run_date)), f"{root.rstrip('/')}/{run_date}/incident_gps_check_csv")
    return paths


def main(argv):
    layout_path, out, run_date = argv[1:4]
    local = "--local" in argv[4:]
    spark = get_session("local[*]" if local else None, app="pluvio-publish",
                        conf=None if local else CLUSTER_CONF)
    spec = json.loads(spark.read.option("wholetext", True).text(layout_path).first()[0])
    kw = {k: cls(**spec.pop(k)) for k, cls in (("rules", pl.GaugeRules), ("period", pl.Period)) if k in spec}
    write(from_exports(spark, exports.Layout(**spec), **kw), out, run_date)


if __name__ == "__main__":
    main(sys.argv)
