import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from pluvio.operators import geo, joins
from pluvio.operators.running import running_sum
from tests.conftest import rows

SQUARES = [("A", [(0, 0), (2, 0), (2, 2), (0, 2)]), ("B", [(1, 1), (3, 1), (3, 3), (1, 3)]),
           ("T", [(4, 0), (6, 0), (5, 2)])]


def brute_inside(x, y, ring):
    inside = False
    for i in range(len(ring)):
        (ax, ay), (bx, by) = ring[i], ring[(i + 1) % len(ring)]
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            inside = not inside
    return inside


def _polys(spark):
    v = spark.createDataFrame([(n, i, float(x), float(y)) for n, ring in SQUARES for i, (x, y) in enumerate(ring)],
                              "name string, seq int, x double, y double")
    return geo.polygon_edges(v)


def _points(spark, n=400):
    random.seed(3)
    pts = [(i, random.uniform(-0.5, 6.5), random.uniform(-0.5, 3.5)) for i in range(n)]
    return pts, spark.createDataFrame(pts, "point_id long, x double, y double")


def test_locate_matches_brute_force_with_fanout(spark):
    pts, df = _points(spark)
    for band in (0.5, 3.0):
        got = rows(geo.locate(df, _polys(spark), "point_id", band=band), "point_id", "polygon_name")
        want = []
        for pid, x, y in pts:
            names = [n for n, ring in SQUARES if brute_inside(x, y, ring)]
            want += [(pid, n) for n in names] or [(pid, None)]
        assert got == sorted(want, key=repr)


def test_count_within_and_status(spark):
    pts, df = _points(spark)
    got = {r["point_id"]: (r["n_within"], r["location_status"]) for r in
           geo.count_within(df, _polys(spark), "point_id").collect()}
    for pid, x, y in pts:
        n = sum(brute_inside(x, y, ring) for _, ring in SQUARES)
        assert got[pid] == (n, geo.INSIDE if n else geo.OUTSIDE)


def test_unbroadcast_path_same_result(spark, monkeypatch):
    pts, df = _points(spark, 100)
    a = rows(geo.locate(df, _polys(spark), "point_id"), "point_id", "polygon_name")
    monkeypatch.setattr(joins, "BROADCAST_MAX_ROWS", 0)
    monkeypatch.setattr(geo, "broadcast_if_small", lambda d, max_rows=0: joins.broadcast_if_small(d, 0))
    assert rows(geo.locate(df, _polys(spark), "point_id"), "point_id", "polygon_name") == a


def test_ring_order_by_seq_any_start(spark):
    # vertices numbered from 1 and listed out of order still close the ring
    v = spark.createDataFrame([("Q", 3, 2.0, 2.0), ("Q", 1, 0.0, 0.0), ("Q", 4, 0.0, 2.0), ("Q", 2, 2.0, 0.0)],
                              "name string, seq int, x double, y double")
    p = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 1.0), (3, None, 1.0)], "point_id long, x double, y double")
    got = rows(geo.locate(p, geo.polygon_edges(v), "point_id"), "point_id", "polygon_name")
    assert got == [(1, "Q"), (2, None), (3, None)]


def test_lookup_fallback(spark):
    df = spark.createDataFrame([(1, "Camp 03"), (2, "Camp 9"), (3, None)], "id int, camp string")
    m = spark.createDataFrame([("Camp 03", "Camp 3")], "old_name string, new_name string")
    assert rows(geo.lookup_with_fallback(df, m, "camp"), "id", "camp") == [(1, "Camp 3"), (2, "Camp 9"), (3, None)]


def test_running_sum_hot_group(spark):
    # one group holds most rows; result must equal the single-window answer
    data = [("hot", i % 37, i) for i in range(6000)] + [("cold", i % 5, i) for i in range(50)]
    df = spark.createDataFrame(data, "g string, c long, item long").repartition(6)
    got = running_sum(df, ["g"], [F.col("c").desc(), F.col("item").asc()], "c", "cum", partitions=8)
    w = Window.partitionBy("g").orderBy(F.col("c").desc(), F.col("item").asc()).rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("cum", F.sum("c").over(w))
    assert rows(got, "g", "item", "cum") == rows(ref, "g", "item", "cum")


def test_rings_holes_gaps_and_repeated_keys(spark):
    ring = lambda name, r, seqs, pts: [(name, r, s, float(x), float(y)) for s, (x, y) in zip(seqs, pts)]
    box = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    v = ring("A", 0, (0, 1, 2, 3), box(0, 4)) + ring("A", 1, (0, 1, 2, 3), box(1, 2)) + ring("A", 2, (5, 9, 12, 40), box(10, 12))
    e = geo.polygon_edges(spark.createDataFrame(v, "name string, ring_id int, seq int, x double, y double"))
    assert e.count() == 12
    pts = [(1, 0.5, 0.55), (1, 0.5, 0.55), (2, 1.5, 1.55), (3, 11.0, 11.05), (4, 7.0, 3.05), (1, 7.0, 3.05), (5, None, 1.0)]
    p = spark.createDataFrame(pts, "point_id int, x double, y double")
    got = rows(geo.locate(p, e, "point_id"), "point_id", "polygon_name")
    assert got == sorted([(1, "A"), (1, "A"), (2, None), (3, "A"), (4, None), (1, None), (5, None)], key=repr)
    assert rows(geo.count_within(p, e, "point_id"), "point_id", "n_within") == [(1, 0), (1, 1), (1, 1), (2, 0), (3, 1), (4, 0), (5, 0)]


def test_cells_follow_the_polygons(spark):
    # many small polygons beside a large one, in coordinates of metres: few rows an edge,
    # few edges a position, and the same answers as brute force
    random.seed(5)
    shapes = [(f"S{i}", [(x, y), (x + 90.0, y), (x + 90.0, y + 70.0), (x, y + 75.0)])
              for i in range(60) for x, y in [(random.uniform(0, 9e4), random.uniform(0, 9e4))]]
    shapes.append(("big", [(0.0, 0.0), (1e5, 10.0), (1e5, 1e5), (5.0, 1e5)]))
    v = spark.createDataFrame([(n, i, x, y) for n, ring in shapes for i, (x, y) in enumerate(ring)],
                              "name string, seq int, x double, y double")
    e = geo.polygon_edges(v)
    sized = geo.sized_edges(e)
    assert geo.edge_bands(sized).count() <= 6 * e.count() and geo.cell_cover(sized).count() <= 16 * e.count()
    near = [(x + random.uniform(-20, 120), y + random.uniform(-20, 90)) for _, ((x, y), *_) in shapes]
    pts = list(enumerate(near + [(random.uniform(-10, 1e5), random.uniform(-10, 1e5)) for _ in range(60)]))
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in pts], "point_id int, x double, y double")
    got = rows(geo.locate(df, e, "point_id"), "point_id", "polygon_name")
    want = []
    for i, (x, y) in pts:
        names = [n for n, ring in shapes if brute_inside(x, y, ring)]
        want += [(i, n) for n in names] or [(i, None)]
    assert got == sorted(want, key=repr)


def _wavy(n, cx, cy, r):
    """A closed line of n vertices around (cx, cy) that goes in and out."""
    import math
    at = [(2 * math.pi * i / n, r * (1 + 0.2 * math.sin(40 * math.pi * i / n) + 0.01 * (i % 2))) for i in range(n)]
    return [(cx + d * math.cos(a), cy + d * math.sin(a)) for a, d in at]


def test_inside_cells_need_no_edge_tests(spark):
    shapes = [("wavy", _wavy(4000, 0.0, 0.0, 10.0)), ("island", _wavy(50, 30.0, 0.0, 2.0)), ("box", [(-20.0, -3.0), (40.0, -3.0), (40.0, 3.0), (-20.0, 3.0)])]
    v = spark.createDataFrame([(n, i, x, y) for n, ring in shapes for i, (x, y) in enumerate(ring)], "name string, seq int, x double, y double")
    e = geo.polygon_edges(v)
    random.seed(8)
    pts = [(i, random.uniform(-22, 42), random.uniform(-14, 14)) for i in range(1500)] + [(2000 + i, x, y) for i, (x, y) in enumerate(shapes[0][1][::40])]
    df = spark.createDataFrame(pts, "point_id int, x double, y double")
    got = rows(geo.locate(df, e, "point_id"), "point_id", "polygon_name")
    want = []
    for i, x, y in pts:
        names = [n for n, ring in shapes if brute_inside(x, y, ring)]
        want += [(i, n) for n in names] or [(i, None)]
    assert got == sorted(want, key=repr)
    sized = geo.sized_edges(e)
    inside, pairs = geo.edge_tests(df, sized, geo.cell_cover(sized))
    in_wavy = sum(brute_inside(x, y, shapes[0][1]) for _, x, y in pts[:1500])
    settled = inside.filter("name = 'wavy'").count()
    assert settled > 0.6 * in_wavy
    # all edges to the right, or of the band, would be thousands a point
    assert pairs.count() < 40 * len(pts)


def test_one_ring_spreads_over_many_tasks(spark):
    from pyspark.sql import functions as F
    ring = _wavy(3000, 0.0, 0.0, 5.0)
    v = spark.createDataFrame([("hot", 0, i, x, y) for i, (x, y) in enumerate(ring)] + [("small", 7, i, float(i), float(i * i)) for i in range(3)]
                              + [(None, 0, i, float(i), 1.0 - i) for i in range(3)], "name string, ring_id int, seq int, x double, y double").repartition(5)
    e = geo.polygon_edges(v, partitions=8)
    got = {(r["ax"], r["ay"]): (r["bx"], r["by"]) for r in e.filter("name = 'hot'").collect()}
    assert got == dict(zip(ring, ring[1:] + ring[:1], strict=True))
    assert rows(e.filter("name = 'small'").select("ax", "bx")) == [(0.0, 1.0), (1.0, 2.0), (2.0, 0.0)]
    assert rows(e.filter("name is null").select("ax", "bx")) == [(0.0, 1.0), (1.0, 2.0), (2.0, 0.0)]
    spread = v.repartitionByRange(8, "name", "ring_id", "seq").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) >= 6 and max(r["count"] for r in spread) < 1000


def test_broadcast_is_bound_in_bytes(spark):
    df = spark.createDataFrame([("x" * 1000, 1)] * 20, "t string, n int")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString()
    assert hinted(joins.broadcast_if_small(df)) and not hinted(joins.broadcast_if_small(df, max_bytes=20_000))
    assert not hinted(joins.broadcast_if_small(df, max_rows=19))
