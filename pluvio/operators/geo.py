"""Points against polygons: count of containing polygons, spatial left join
(fanning out where polygons overlap) and reported-vs-located consistency.

Polygons stay a vertex table; nothing is gathered per polygon. Edges pair each vertex with
the next one of its ring by ``seq``, the last with the first; a ring's vertices are
range-partitioned by ``seq``, so one of any length spreads over many tasks. A polygon is
covered by square cells, a few dozen across: those that an edge passes through, and those
wholly inside, which a count of crossings along each row of cells tells. An equi-join of
positions and cells settles what lies in an inside cell; only positions in an edge's cell
are tested against edges, those of that polygon in the band of that height, by the
even-odd rule. Edges and cover are written once (reliable checkpoint) and read by every
consumer. Spark picks the joins by the measured size of their sides and splits a hot cell."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.operators.joins import broadcast_if_small
from pluvio.session import pin

INSIDE = "inside_camp_boundary"
OUTSIDE = "outside_camp_boundary"
#: Cells that the longer side of a polygon's box spans at most; about an eighth as many as
#: the polygon has edges, if that is less, so a cover has a few cells an edge
ACROSS = 64


def polygon_edges(vertices: DataFrame, name: str = "name", seq: str = "seq",
                  x: str = "x", y: str = "y", ring: str = "ring_id", partitions: int | None = None) -> DataFrame:
    """Vertex table (name, [ring_id,] seq, x, y) -> edges (name, ax, ay, bx, by),
    closing each ring from its last vertex to its first, written once. ``seq`` only orders
    the vertices of a ring (gaps are fine). A polygon may have several rings (islands and
    holes): the even-odd rule counts the crossings of all of them.

    The vertices are range-partitioned by ring and ``seq``. A vertex finds the next one in
    its partition; the last of a partition's slice of a ring takes the first of the ring's
    next slice, from a table of one row a slice."""
    ring_id = F.col(ring) if ring in vertices.columns else F.lit(0)
    n = partitions or int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = vertices.select(F.col(name).alias("name"), ring_id.alias("ring_id"), F.col(seq).alias("seq"),
                        F.col(x).cast("double").alias("ax"), F.col(y).cast("double").alias("ay"))
    # both consumers must see the same vertex -> slice assignment: pin it
    v = pin(v.repartitionByRange(n, "name", "ring_id", "seq").withColumn("_slice", F.spark_partition_id()))
    here = Window.partitionBy("_slice", "name", "ring_id").orderBy("seq")
    end = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    local = v.withColumn("_next", F.lead(end).over(here))
    heads = v.groupBy("name", "ring_id", "_slice").agg(F.min_by("ax", "seq").alias("x"), F.min_by("ay", "seq").alias("y"))
    ring_w = Window.partitionBy("name", "ring_id").orderBy("_slice")
    head, so_far = F.struct("x", "y"), ring_w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = heads.select(F.col("name").alias("_name"), F.col("ring_id").alias("_ring"), F.col("_slice").alias("_of"),
                         F.coalesce(F.lead(head).over(ring_w), F.first(head).over(so_far)).alias("_head"))
    j = local.join(after, (local["_slice"] == after["_of"]) & local["name"].eqNullSafe(after["_name"])
                   & local["ring_id"].eqNullSafe(after["_ring"]))
    to = F.coalesce("_next", "_head")
    return pin(j.select("name", "ax", "ay", to["x"].alias("bx"), to["y"].alias("by")))


def _up(size):
    """The least power of four that is no smaller; 1 for sizes of 0."""
    return F.when(size > 0, F.pow(F.lit(4.0), F.ceil(F.log(4.0, size)))).otherwise(F.lit(1.0))


def sized_edges(edges: DataFrame, band: float | None = None) -> DataFrame:
    """Edges with finite ends and, of their polygon, the size of its cells (``_c``) and the
    height of its bands (``_h``: its mean edge's, or ``band``), both powers of four."""
    e = edges
    for c in ("ax", "ay", "bx", "by"):
        e = e.filter(F.abs(c) < float("inf"))
    height = F.avg(F.when(F.col("ay") != F.col("by"), F.abs(F.col("by") - F.col("ay"))))
    wide = F.max(F.greatest("ax", "bx")) - F.min(F.least("ax", "bx"))
    high = F.max(F.greatest("ay", "by")) - F.min(F.least("ay", "by"))
    across = F.least(F.lit(ACROSS), F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / 8)))
    sizes = e.groupBy(F.col("name").alias("_name")).agg(
        _up(F.greatest(wide, high) / across).alias("_c"),
        (_up(F.coalesce(height, F.lit(0.0))) if band is None else F.lit(float(band))).alias("_h"))
    return e.join(sizes, F.col("name").eqNullSafe(F.col("_name"))).drop("_name")


def edge_bands(sized: DataFrame) -> DataFrame:
    """One row per (edge, band that its y-range touches), three an edge on average.
    Horizontal edges never cross a horizontal ray and are left out."""
    return sized.filter(F.col("ay") != F.col("by")).withColumn("_band", F.explode(F.sequence(
        F.floor(F.least("ay", "by") / F.col("_h")), F.floor(F.greatest("ay", "by") / F.col("_h")))))


def cell_cover(sized: DataFrame) -> DataFrame:
    """(name, _c, _row, _col, inside) of the cells that a polygon meets: those that an edge
    passes through (inside is false), and those wholly inside. Cells left out are outside."""
    c, ax, ay, bx, by = map(F.col, ("_c", "ax", "ay", "bx", "by"))
    rows = sized.withColumn("_row", F.explode(F.sequence(F.floor(F.least("ay", "by") / c), F.floor(F.greatest("ay", "by") / c))))
    # the part of the edge in the row, widened by more than rounding makes
    lo_y, hi_y = F.greatest(F.least("ay", "by"), F.col("_row") * c), F.least(F.greatest("ay", "by"), (F.col("_row") + 1) * c)
    at = [F.when(ay == by, end).otherwise(ax + (bx - ax) * (yy - ay) / (by - ay)) for yy, end in ((lo_y, ax), (hi_y, bx))]
    room = (F.abs(ax) + F.abs(bx)) * 1e-12
    lo = F.greatest(F.least(*at), F.least("ax", "bx")) - room
    hi = F.least(F.greatest(*at), F.greatest("ax", "bx")) + room
    keys = ["name", "_c", "_row"]
    touched = pin(rows.withColumn("_col", F.explode(F.sequence(F.floor(lo / c), F.floor(hi / c)))).select(*keys, "_col").distinct())
    # the other cells between a row's first and last touched one, in one order with the
    # places where edges cross the row's middle
    between = touched.groupBy(*keys).agg(F.min("_col").alias("_from"), F.max("_col").alias("_to")).filter("_to > _from + 1").select(
        *keys, F.explode(F.sequence(F.col("_from") + 1, F.col("_to") - 1)).alias("_col"))
    t = touched.select(*[F.col(k).alias(f"t{k}") for k in (*keys, "_col")])
    same = F.col("name").eqNullSafe(F.col("tname"))
    for k in ("_c", "_row", "_col"):
        same = same & (F.col(k) == F.col(f"t{k}"))
    free = between.join(t, same, "left_anti").select(*keys, ((F.col("_col") + 0.5) * c).alias("_x"), "_col", F.lit(0).alias("_cross"))
    middle = (F.col("_row") + 0.5) * c
    cross = rows.filter((ay > middle) != (by > middle)).select(
        *keys, ((bx - ax) * (middle - ay) / (by - ay) + ax).alias("_x"), F.lit(None).cast("bigint").alias("_col"), F.lit(1).alias("_cross"))
    right = Window.partitionBy(*keys).orderBy(F.desc("_x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (free.union(cross).withColumn("_n", F.sum("_cross").over(right))
              .filter(F.col("_col").isNotNull() & (F.col("_n") % 2 == 1)))
    return touched.withColumn("inside", F.lit(False)).union(inside.select(*keys, "_col", F.lit(True).alias("inside")))


def edge_tests(points: DataFrame, sized: DataFrame, cover: DataFrame, x: str = "x", y: str = "y") -> tuple[DataFrame, DataFrame]:
    """(positions in inside cells with their polygon, pairs of a position and an edge to
    test). Positions are distinct, so points that share a place are looked up once."""
    sizes = cover.select(F.collect_set("_c").alias("v")).scalar()  # a handful of powers of four
    pts = points.select(F.col(x).alias("_x"), F.col(y).alias("_y")).filter(
        F.col("_x").isNotNull() & F.col("_y").isNotNull()).distinct().withColumn("_pc", F.explode(sizes))
    pts = pts.withColumns({"_prow": F.floor(F.col("_y") / F.col("_pc")), "_pcol": F.floor(F.col("_x") / F.col("_pc"))})
    hit = pts.join(cover, (pts["_pc"] == cover["_c"]) & (pts["_prow"] == cover["_row"]) & (pts["_pcol"] == cover["_col"]))
    near = hit.filter(~F.col("inside")).select("_x", "_y", F.col("name").alias("_pname"))
    bands = edge_bands(sized)
    heights = sized.groupBy(F.col("name").alias("_hname")).agg(F.first("_h").alias("_ph"))
    near = near.join(heights, F.col("_pname").eqNullSafe(F.col("_hname"))).withColumn("_pband", F.floor(F.col("_y") / F.col("_ph")))
    pairs = near.join(bands, F.col("_pname").eqNullSafe(F.col("name")) & (F.col("_pband") == F.col("_band")))
    return hit.filter("inside").select("_x", "_y", "name"), pairs


def crossings(points: DataFrame, edges: DataFrame, x: str = "x", y: str = "y",
              band: float | None = None) -> DataFrame:
    """(_x, _y, name) for every polygon that contains the position: it lies in an inside
    cell, or the ray from it towards +x crosses the boundary an odd number of times."""
    sized = pin(sized_edges(edges, band))
    inside, pairs = edge_tests(points, sized, pin(cell_cover(sized)), x, y)
    px, py, ax, ay, bx, by = map(F.col, ("_x", "_y", "ax", "ay", "bx", "by"))
    straddles = (ay > py) != (by > py)
    right = px < (bx - ax) * (py - ay) / (by - ay) + ax
    odd = (pairs.filter(straddles & right).groupBy("_x", "_y", "name").agg(F.count(F.lit(1)).alias("_n"))
           .filter(F.col("_n") % 2 == 1))
    return inside.union(odd.select("_x", "_y", "name"))


def locate(points: DataFrame, edges: DataFrame, key: str, x: str = "x", y: str = "y",
           out: str = "polygon_name", band: float | None = None) -> DataFrame:
    """Each point joined to every polygon containing it (one row per polygon, or
    one row with a null name when inside none). Points with a null coordinate
    match nothing."""
    inside = crossings(points, edges, x, y, band).withColumnRenamed("name", out)
    return points.join(inside, (points[x] == inside["_x"]) & (points[y] == inside["_y"]), "left").drop("_x", "_y")


def count_within(points: DataFrame, edges: DataFrame, key: str, x: str = "x", y: str = "y",
                 band: float | None = None) -> DataFrame:
    """Per row of ``points``: number of polygons containing it and inside/outside status."""
    n = crossings(points, edges, x, y, band).groupBy("_x", "_y").agg(F.count("name").alias("_n"))
    c = points.join(n, (points[x] == n["_x"]) & (points[y] == n["_y"]), "left").select(
        points[key], F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_within"))
    return c.withColumn("location_status", F.when(F.col("n_within") == 0, OUTSIDE).otherwise(INSIDE))


def consistency(located: DataFrame, reported: str, located_name: str, out: str = "camp_consistency"):
    """Reported name equals located name; null when either is null."""
    return located.withColumn(out, F.col(reported) == F.col(located_name))


def lookup_with_fallback(df: DataFrame, mapping: DataFrame, col: str, old: str = "old_name",
                         new: str = "new_name", out: str | None = None) -> DataFrame:
    """Replace ``col`` through an (old -> new) table, keeping the original where
    the table has no entry. The map is broadcast only when proven small."""
    m = broadcast_if_small(mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new")))
    j = df.join(m, df[col] == m["_old"], "left")
    return j.withColumn(out or col, F.coalesce(F.col("_new").cast("string"), df[col])).drop("_old", "_new")
