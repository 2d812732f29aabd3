"""Readers for the exports the pipelines take in: delimited text with several
null strings, folders of files selected by name, tab files whose header spans two
lines, and mapping / vertex tables.

Text is read as text (no schema inference) and typed afterwards with ``try_*``
casts, so a bad cell becomes null instead of failing the job."""
from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.functions.nulls import null_tokens

# fixed values: strings read as "no value"
DEFAULT_NULLS = ("NA", "", " ")
#: Header cells left empty: as Spark names them, and as a table written with names for them
UNNAMED = r"|_c\d+|[xX](\.\d+)?"
HEADER_BYTES = 1 << 20  # of a file, to find its first line in


def normalize_names(names) -> list[str]:
    """Header text -> usable snake_case names: non-alphanumerics become '_',
    lower case, an empty header cell becomes 'x', a leading digit gets an 'x_'
    prefix, repeats get _1, _2..."""
    out, seen = [], {}
    for n in names:
        if n is None or re.fullmatch(r"_c\d+", n):   # a header cell left empty
            n = ""
        s = re.sub(r"[^0-9a-zA-Z]+", "_", n.strip()).strip("_").lower() or "x"
        if s[0].isdigit():
            s = "x_" + s
        if s in seen:
            seen[s] += 1
            s = f"{s}_{seen[s]}"
        else:
            seen[s] = 0
        out.append(s)
    return out


def read_delimited(spark: SparkSession, path, nulls=DEFAULT_NULLS, sep: str = ",",
                   header: bool = True, normalize: bool = True, multi_line: bool = True,
                   drop_unnamed: bool = False) -> DataFrame:
    """Delimited text, every column as text, cells equal to one of ``nulls`` -> null.
    Quoted cells may hold separators, doubled quotes and line breaks; a file is then one
    scan split. (Empty cells are read by way of a character no text holds, because an
    empty header cell read as null fails a scan over line breaks.) ``multi_line=False`` splits
    large files whose cells hold no line break. ``drop_unnamed`` leaves out the columns
    without a header."""
    df = (spark.read.option("header", header).option("sep", sep).option("inferSchema", False)
          .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
          .option("nullValue", "\0").csv(path))
    names = normalize_names(df.columns) if normalize else df.columns
    return df.select(*[null_tokens(F.col(f"`{c}`"), nulls).alias(n) for c, n in zip(df.columns, names)
                       if not (drop_unnamed and re.fullmatch(UNNAMED, c.strip()))])


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """File paths in ``folder`` whose name matches the glob ``pattern`` (names only;
    file contents are not read)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .load(folder).select("path"))
    return sorted(r[0] for r in files.collect())


def first_lines(spark: SparkSession, paths) -> dict[str, str]:
    """The first line of each file, by the file system that Spark reads with. Of a file no
    more than its first HEADER_BYTES are opened, whatever its size; a longer first line is
    an error."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(path):
        at = jvm.org.apache.hadoop.fs.Path(path)
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = codecs.getCodec(at)
            text = codec.createInputStream(stream) if codec is not None else stream
            got = b""
            for size in (1 << 13, HEADER_BYTES - (1 << 13)):
                more = bytes(text.readNBytes(size))
                got += more
                if b"\n" in more or len(more) < size:
                    return got.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r").removeprefix("\ufeff")
        finally:
            stream.close()
        raise ValueError(f"{path}: its first line has more than {HEADER_BYTES} bytes")

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(first, paths), strict=True))


def files_by_header(spark: SparkSession, folder: str, pattern: str) -> list[list[str]]:
    """File paths grouped by their first line. A file whose first line ends inside quotes
    (its header goes on) is a group of its own."""
    groups: dict[tuple, list[str]] = {}
    for path, line in first_lines(spark, list_files(spark, folder, pattern)).items():
        groups.setdefault((line, path if line.count('"') % 2 else None), []).append(path)
    return sorted(sorted(paths) for paths in groups.values())


def read_folder(spark: SparkSession, folder: str, pattern: str, nulls=DEFAULT_NULLS,
                sep: str = ",", drop_unnamed: bool = False, multi_line: bool = True) -> DataFrame:
    """All files of a folder matching ``pattern``, unioned by column name (a
    column missing from a file is null there). A multi-file CSV scan maps columns by
    position, so files with the same header line share a scan, and each header has its own.
    With ``multi_line=False``, for cells without line breaks, a large file makes several
    splits."""
    frames = []
    for paths in files_by_header(spark, folder, pattern):
        broken = len(paths) == 1 and first_lines(spark, paths)[paths[0]].count('"') % 2 == 1
        frames.append(read_delimited(spark, paths, nulls, sep, multi_line=multi_line or broken, drop_unnamed=drop_unnamed))
    if not frames:
        raise FileNotFoundError(f"no file matching {pattern} in {folder}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def read_two_line_header(spark: SparkSession, path: str, sep: str = "\t",
                         nulls=DEFAULT_NULLS) -> DataFrame:
    """Tab export whose column names span two lines ('Hi' over 'Temp'): the
    names are the two lines joined with '.', then normalised; the two header lines
    (and any repeat of them inside the file) are dropped from the data."""
    head = [r[0] for r in spark.read.text(path).limit(2).collect()]
    h1, h2 = (head + ["", ""])[:2]
    f1, f2 = h1.split(sep), h2.split(sep)
    width = max(len(f1), len(f2))
    f1 += [""] * (width - len(f1))
    f2 += [""] * (width - len(f2))
    names = normalize_names([f"{a}.{b}" for a, b in zip(f1, f2)])
    # the width is that of the wider header line, not of the first
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.option("header", False).option("sep", sep).schema(schema).csv(path)
    line = F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns])
    headers = [sep.join(f[:len(raw.columns)]) for f in (f1, f2)]
    return raw.filter(~line.isin(headers)).select(*[null_tokens(c, nulls).alias(c) for c in raw.columns])


def read_mapping(spark: SparkSession, path: str, nulls=DEFAULT_NULLS) -> DataFrame:
    """Rename / name-correction table (old_name, new_name[, dataset])."""
    return read_delimited(spark, path, nulls)


def read_vertices(spark: SparkSession, path: str, name="name", seq="seq", x="x", y="y",
                  ring_id="ring_id") -> DataFrame:
    """Polygon vertex table (name, ring_id, seq, x, y) as text -> typed; without a ring
    column each polygon has one ring."""
    t = read_delimited(spark, path)
    ring = F.col(ring_id).try_cast("int") if ring_id in t.columns else F.lit(0)
    return t.select(F.col(name).alias("name"), ring.alias("ring_id"), F.col(seq).try_cast("int").alias("seq"),
                    F.col(x).try_cast("double").alias("x"), F.col(y).try_cast("double").alias("y"))
