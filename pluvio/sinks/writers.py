"""Publication of the tables: parquet per table under a run folder, CSV exports,
and display formats for dates.

A run writes into a folder of its own and, when all its tables are there, one file with a
row for each table (for a partitioned one, each partition) and where it lies: the manifest.
Readers go by the last manifest, so a run that fails half-way changes nothing for them, and
files once published are never written again. Publishing some partitions anew writes those
alone; the next manifest points to them and to the others' files where they were."""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: display formats of the published tables
DATETIME_DISPLAY = "dd/MM/yyyy HH:mm"
DATE_DISPLAY = "dd/MM/yyyy"


def display_dates(df: DataFrame) -> DataFrame:
    """Dates as 'dd/MM/yyyy' text and timestamps as 'dd/MM/yyyy HH:mm' text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            out.append(F.date_format(c, DATE_DISPLAY).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append(F.date_format(c, DATETIME_DISPLAY).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


MANIFEST = "_manifest"
_ENTRY = "number long, run string, name string, base string, partition string, about string"


def publish(tables: dict[str, DataFrame], root: str, run_date: str,
            partition_by: dict[str, list[str]] | None = None, about: dict[str, dict] | None = None) -> dict[str, str]:
    """Write each table as parquet to a folder of this run under ``root`` and then the
    manifest; the paths by table. ``partition_by`` names partition columns per table (e.g.
    month of the daily table, so readers prune by month), ``about`` whatever a reader is to
    know of a table. Tables of earlier runs that this one doesn't write stay published."""
    partition_by, about = partition_by or {}, about or {}
    run = f"{run_date}-{uuid.uuid4().hex[:8]}"
    paths = {name: _write(df, f"{root.rstrip('/')}/{run}/{name}", partition_by.get(name)) for name, df in tables.items()}
    for spark in {df.sparkSession for df in tables.values()}:
        new = [(run, name, path, part, json.dumps(about.get(name, {})))
               for name, path in paths.items() for part in _partitions(spark, path, partition_by.get(name))]
        kept = [e for e in manifest(spark, root) if e["name"] not in paths]
        _commit(spark, root, new + [(e["run"], e["name"], e["base"], e["partition"], e["about"]) for e in kept])
    return paths


def publish_partitions(df: DataFrame, root: str, run_date: str, name: str, columns: list[str]) -> str:
    """Publish the partitions of table ``name`` that ``df`` has rows of, in place of what
    was published of them; the table's other partitions stay as they are."""
    spark = df.sparkSession
    run = f"{run_date}-{uuid.uuid4().hex[:8]}"
    path = _write(df, f"{root.rstrip('/')}/{run}/{name}", columns)
    parts = _partitions(spark, path, columns)
    before = manifest(spark, root)
    about = next((e["about"] for e in before if e["name"] == name), "{}")
    kept = [e for e in before if e["name"] != name or e["partition"] not in parts]
    _commit(spark, root, [(run, name, path, p, about) for p in parts]
            + [(e["run"], e["name"], e["base"], e["partition"], e["about"]) for e in kept])
    return path


def _write(df: DataFrame, path: str, columns: list[str] | None) -> str:
    w = df.write.mode("errorifexists")
    (w.partitionBy(*columns) if columns else w).parquet(path)
    return path


def _partitions(spark: SparkSession, path: str, columns: list[str] | None) -> list[str]:
    """The partition folders of a table, as Spark names them; one empty name without. A
    table published by month has as many as it has months."""
    if not columns:
        return [""]
    folder = F.regexp_extract(F.col("_metadata.file_path"), "/((?:[^/=]+=[^/]*/?)+)/[^/]*$", 1)
    return sorted(r[0] for r in spark.read.parquet(path).select(folder.alias("p")).distinct().collect())


def _commit(spark: SparkSession, root: str, entries: list) -> None:
    """A new manifest: one file, which the writer's commit puts in place whole."""
    number = max((e["number"] for e in manifest(spark, root)), default=0) + 1
    rows = spark.createDataFrame([(number, *e) for e in entries], _ENTRY)
    rows.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/{MANIFEST}")


def manifest(spark: SparkSession, root: str) -> list:
    """The entries of the last manifest under ``root``; none if nothing is published."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return []
    every = spark.read.schema(_ENTRY).json(path)
    return every.filter(F.col("number") == every.select(F.max("number")).scalar()).orderBy("name", "partition").collect()


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table as the last manifest has it."""
    bases: dict[str, list[str]] = {}
    for e in manifest(spark, root):
        if e["name"] == name:
            bases.setdefault(e["base"], []).append(f"{e['base']}/{e['partition']}".rstrip("/"))
    if not bases:
        raise FileNotFoundError(f"{name} is not published under {root}")
    frames = [spark.read.option("basePath", base).parquet(*paths) for base, paths in sorted(bases.items())]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_csv(df: DataFrame, path: str, display: bool = True) -> str:
    """CSV export with a header line (dates in display format when ``display``)."""
    (display_dates(df) if display else df).write.mode("overwrite").option("header", True).csv(path)
    return path


def with_month(df: DataFrame, date: str = "date", name: str = "month") -> DataFrame:
    """Partition column yyyy-MM for the daily table."""
    return df.withColumn(name, F.date_format(date, "yyyy-MM"))
