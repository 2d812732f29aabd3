"""Near-dedup of embeddings by random-hyperplane signs.

Vectors with equal labels are compared by cosine. Equal vectors are one class. In each
of several tables the signs of a class's products with random planes name its bucket;
buckets are compared in blocks by a matrix product, so neither a bucket nor its pairs
need to fit anywhere. What travels into every table is a class's signs and its vector in
16-bit steps with the error that this makes: the product then bounds the cosine from both
sides and settles nearly all pairs. The few pairs with the threshold within the bounds
are settled in double precision, each once. A pair counts in the first table in which it
shares a bucket. Links per vector are added up, and each block passes on a spanning
forest of what it linked; components come from distributed rounds over these edges.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio.llm.common import connected_components, local_roots, partitions, store, widened

MISS = 1e-5      # chance that a pair at the threshold shares no bucket in any table
BUCKET = 256     # classes wanted in a bucket when directions are spread evenly
BLOCK = 256      # rows of a block
STEPS = 32767    # of the largest component of a vector, in what travels


def bits_and_tables(classes: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Planes a table so that an even bucket of the largest label holds BUCKET classes,
    and tables so that a pair at the threshold is missed with ``miss`` at most."""
    bits = min(40, max(4, round(math.log2(max(1, classes) / BUCKET))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log(1 - agree))


def planes(dim: int, bits: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))


def _usable(values) -> np.ndarray | None:
    """The vector in double precision, or None if it links with nothing."""
    if values is None or None in values:
        return None
    v = np.array(values, dtype=np.float64) + 0.0
    return v if len(v) and np.isfinite(v).all() and v.any() else None


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()  # squares neither vanish nor overflow
    return v / np.sqrt((v * v).sum())


def _keyed(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """vec_id, label, digest of the vector (null if it links with nothing), unit vector."""
    def go(batches):
        for batch in batches:
            k0, k1, dim, unit = [], [], [], []
            for vid, label, value in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                v = None if vid.as_py() is None or label.as_py() is None else _usable(value.as_py())
                d = (None, None) if v is None else np.frombuffer(xxhash.xxh3_128_digest(v.tobytes()), np.int64).tolist()
                k0.append(d[0])
                k1.append(d[1])
                dim.append(None if v is None else len(v))
                unit.append(None if v is None else _unit(v))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(k0, pa.int64()), pa.array(k1, pa.int64()),
                 pa.array(dim, pa.int32()), pa.array(unit, pa.list_(pa.float64()))],
                names=["vec_id", "label", "k0", "k1", "dim", "unit"])

    return vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vec_col}`").cast("array<double>").alias("v")).mapInArrow(
        go, "vec_id long, label string, k0 long, k1 long, dim int, unit array<double>")


def _packed(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``classes`` (cid, n, unit) with the code of each table, the codes as bytes, the
    vector in steps, the length of a step and the error of the steps."""
    width = (bits + 7) // 8

    def go(batches):
        made: dict[int, np.ndarray] = {}
        weigh = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            codes, packed, steps, scale, error = [], [], [], [], []
            for value in batch.column(batch.schema.get_field_index("unit")):
                u = value.values.to_numpy(zero_copy_only=False)
                p = made.get(len(u))
                if p is None:
                    p = made[len(u)] = planes(len(u), bits, tables, seed)
                code = ((u @ p) >= 0).reshape(tables, bits) @ weigh
                codes.append(code)
                packed.append(code.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
                step = np.abs(u).max() / STEPS
                q = np.rint(u / step).astype("<i2")
                steps.append(q.tobytes())
                scale.append(step)
                rest = u - q * step
                error.append(np.sqrt(rest @ rest))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "unit"),
                 pa.array(codes, pa.list_(pa.int64())), pa.array(packed, pa.binary()), pa.array(steps, pa.binary()),
                 pa.array(scale, pa.float64()), pa.array(error, pa.float64())],
                names=[*(x for x in batch.schema.names if x != "unit"), "codes", "packed", "steps", "scale", "error"])
    return classes.mapInArrow(go, widened(classes.drop("unit"), codes=T.ArrayType(T.LongType()), packed=T.BinaryType(),
                                          steps=T.BinaryType(), scale=T.DoubleType(), error=T.DoubleType()))


def _compare(threshold: float, bits: int, tables: int):
    """From rows of a partition sorted by block pair: (cid, links, root, other) of each
    class that a block pair links; ``links`` counts only what no earlier table shares.
    Pairs that the steps can't settle come once, in the first table they share, with the
    second class as ``other``."""
    width = (bits + 7) // 8

    def side(held):
        dim = held[0]["dim"]
        return {"cid": np.array([h["cid"] for h in held]), "n": np.array([h["n"] for h in held]),
                "unit": np.frombuffer(b"".join(h["steps"] for h in held), "<i2").reshape(-1, dim).astype(np.float64)
                * np.array([h["scale"] for h in held])[:, None],
                "error": np.array([h["error"] for h in held]),
                "codes": np.frombuffer(b"".join(h["packed"] for h in held), np.uint8).reshape(-1, tables, width)}

    def block(x, y, table, same):
        cos = x["unit"] @ y["unit"].T
        # the steps' errors, and far more than rounding makes
        margin = 1.01 * (x["error"][:, None] + y["error"]) + 1e-9
        if same:
            np.fill_diagonal(cos, -np.inf)
        a, b = np.nonzero(cos >= threshold - margin)
        if not len(a):
            return []
        new = np.ones(len(a), bool)
        for t in range(table):
            new &= (x["codes"][a, t] != y["codes"][b, t]).any(axis=1)
        sure = cos[a, b] >= threshold + margin[a, b]
        ask = ~sure & new
        if same:
            ask &= a < b
        out = [(int(i), 0, int(i), int(j)) for i, j in zip(x["cid"][a[ask]], y["cid"][b[ask]], strict=True)]
        a, b, new = a[sure], b[sure], new[sure]
        if not len(a):
            return out
        links = {}
        # in one block both directions of a pair are among the hits already
        for own, at, other, weight in ((x, a, b, y["n"]), (y, b, a, x["n"]))[:1 if same else 2]:
            for cid, n in zip(own["cid"], np.bincount(at, weights=np.where(new, weight[other], 0), minlength=len(own["cid"])), strict=True):
                links[int(cid)] = links.get(int(cid), 0) + int(n)
        return out + [(int(n), links.get(int(n), 0), int(r), None) for n, r in zip(*local_roots(x["cid"][a], y["cid"][b]), strict=True)]

    def go(batches):
        key, held = None, ([], [])

        def made():
            left, right = held
            if key is None or not left or not (right or key[-2] == key[-1]):
                return []
            x = side(left)
            same = key[-2] == key[-1]
            return block(x, x if same else side(right), key[2], same)

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                k = (row["label"], row["dim"], row["tab"], row["code"], row["i"], row["j"])
                if k != key:
                    out += made()
                    key, held = k, ([], [])
                held[0 if row["first"] else 1].append(row)
            yield _linked_batch(out)
        yield _linked_batch(made())
    return go


def _linked_batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)],
                                      names=["cid", "links", "root", "other"])


def _settled(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (cid, other) whose cosine in double precision reaches the threshold:
    (cid, links, root) of both classes."""
    a = classes.select(F.col("cid").alias("a"), F.col("unit").alias("ua"), F.col("n").alias("na"))
    b = classes.select(F.col("cid").alias("b"), F.col("unit").alias("ub"), F.col("n").alias("nb"))
    both = pairs.join(a, pairs["cid"] == a["a"]).join(b, pairs["other"] == b["b"]).select("a", "na", "ua", "b", "nb", "ub")

    def go(batches):
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column(2), batch.column(5), strict=True))
                    if x.values.to_numpy(zero_copy_only=False) @ y.values.to_numpy(zero_copy_only=False) >= threshold]
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(i) for i in (0, 1, 3, 4)], names=["a", "na", "b", "nb"])

    hits = store(both.mapInArrow(go, "a long, na long, b long, nb long"))
    root = F.least("a", "b").alias("root")
    return (hits.select(F.col("a").alias("cid"), F.col("nb").alias("links"), root)
            .union(hits.select(F.col("b").alias("cid"), F.col("na").alias("links"), root)))


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", miss: float = MISS, seed: int = 1) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``. Linked are
    vectors with equal, non-null labels (and lengths) whose cosine is at least
    ``threshold``. Null, empty or zero vectors, those with a null or non-finite
    component, and rows with a null id or label link with nothing; a null id gives a
    null component and is kept. Repeated rows count as vectors of their own for n_links,
    and so do rows that share an id but not vector and label: a class is known by 64 bits
    of hash of label, length and vector, never by an id. Extra columns aren't read."""
    keyed = store(_keyed(vectors, id_col, vec_col, label_col).withColumn("cid", F.when(F.col("k0").isNotNull(), F.xxhash64("label", "dim", "k0", "k1"))))
    classes = store(keyed.filter(F.col("cid").isNotNull()).groupBy("cid").agg(
        F.first("label").alias("label"), F.first("dim").alias("dim"), F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n"),
        F.first("unit").alias("unit")))
    largest = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = bits_and_tables(largest, threshold, miss)
    coded = store(_packed(classes.select("cid", "label", "dim", "n", "unit"), bits, tables, seed))
    placed = coded.select("label", "dim", "cid", F.posexplode("codes").alias("tab", "code"))
    key = ["label", "dim", "tab", "code"]
    sizes = store(placed.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("c"))
                  .filter("c > 1").drop("c").withColumnsRenamed({c: f"_{c}" for c in key}))
    in_bucket = store(placed.join(sizes, [placed[c] == sizes[f"_{c}"] for c in key]).select(*key, "cid", "blocks"))
    # each block of a bucket meets every block of it once: (i, j) with i <= j
    own = F.pmod(F.xxhash64("cid", "tab"), F.col("blocks")).cast("int")
    meets = (in_bucket.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*key, "cid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") <= F.col("other")).alias("first")))
    about = coded.select(F.col("cid").alias("_cid"), "n", "packed", "steps", "scale", "error")
    rows = (meets.join(about, F.col("cid") == F.col("_cid")).drop("_cid")
            .repartition(partitions(vectors.sparkSession), *key, "i", "j")
            .sortWithinPartitions(*key, "i", "j", "cid"))
    found = store(rows.mapInArrow(_compare(threshold, bits, tables), "cid long, links long, root long, other long"))
    linked = found.filter("other is null").select("cid", "links", "root").union(
        _settled(found.filter("other is not null").select("cid", "other"), classes, threshold))
    linked = store(linked)
    comp = connected_components(linked.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    # a component is called by the smallest id of its classes
    named = (comp.join(classes.select(F.col("cid").alias("_cid"), "rep"), comp["id"] == F.col("_cid"))
             .groupBy(F.col("component").alias("_component")).agg(F.min("rep").alias("named")))
    comp = comp.join(store(named), comp["component"] == F.col("_component")).select("id", "named")
    links = linked.groupBy(F.col("cid").alias("_linked")).agg(F.sum("links").alias("links"))
    known = store(classes.join(links, classes["cid"] == links["_linked"], "left").join(comp, classes["cid"] == comp["id"], "left")
                  .select(F.col("cid").alias("_cid"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                          F.coalesce("named", "rep").alias("component")))
    return (keyed.select("vec_id", "cid").join(known, F.col("cid") == F.col("_cid"), "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
