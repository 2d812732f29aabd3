"""Hard-negative mining by angular triangle filtering.

Vectors are quantised to integers and scored by inner products. Each keeps its norm and
its angles to a few reference directions. The angle between two vectors is at least the
difference of their angles to a reference and at most the sum, so the references give an
interval of cosines and, times the norms and widened by more than rounding can do, of
scores. Vectors of one label lie in rings: neighbours by angle to the reference nearest
to them, with the extremes of their angles and norms. A ring whose bounds can't reach an
anchor's window of scores is passed over; in the others a binary search in the sorted
angles cuts the part that can, and that part alone is scored, in integers.

Anchors come in blocks and meet all rings, dealt over many groups; a group's rings stay
in memory while the anchor blocks pass. Equal vectors of one label are one class, of
which only the smallest ids can be among the first of any list.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import partitions, store

REFERENCES = 32
SAMPLE = 2048        # classes, by digest, that the references are chosen from
RING = 512           # classes of a ring at most
RINGS = 32           # rings of a group, about
ANCHORS = 256        # anchor classes of a block at most
NORM = 2.0 ** 31     # of a quantised vector, less than this
SLACK = 1e-6         # of angles, far above rounding


def quantised(values: pa.Scalar, scale: int) -> np.ndarray | None:
    """floor(scale * x) of each component, or None if the vector takes no part."""
    if not values.is_valid or values.values.null_count:
        return None
    q = np.floor(values.values.to_numpy(zero_copy_only=False) * float(scale))
    if not np.isfinite(q).all() or not np.sqrt((q / NORM) @ (q / NORM)) < 1:
        return None
    return q.astype(np.int32)


def spread_out(sample: list, count: int) -> np.ndarray:
    """Unit vectors of the sample, each as far as possible from those before it."""
    unit = np.array([q / np.sqrt(q @ q) for q in np.array(sample, np.float64) if q.any()])
    if not len(unit):
        return np.empty((0, len(sample[0])))
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(count, len(unit)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def angles(q: np.ndarray, references: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Norms of the rows of q, and their angles to the references (a right angle for a
    zero vector). Without references one column of right angles, which bounds nothing."""
    q = q.astype(np.float64)
    norm = np.sqrt((q * q).sum(axis=1))
    if references is None or not len(references):
        return norm, np.full((len(q), 1), np.pi / 2)
    cos = (q @ references.T) / np.where(norm > 0, norm, 1)[:, None]
    return norm, np.arccos(np.clip(cos, -1, 1))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows, exact."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if float(top) ** 2 * a.shape[1] < 2.0 ** 53:  # so in doubles, too
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def score_bounds(norm, angle, ring) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each anchor can have with any vector of a ring."""
    near = np.maximum(np.maximum(angle - ring["hi"], ring["lo"] - angle).max(axis=1) - SLACK, 0)
    far = np.minimum(np.minimum(angle + ring["hi"], 2 * np.pi - angle - ring["lo"]).min(axis=1) + SLACK, np.pi)
    top, low = np.cos(near), np.cos(far)
    most = norm * np.where(top > 0, ring["norm"].max(), ring["norm"].min()) * top
    least = norm * np.where(low > 0, ring["norm"].min(), ring["norm"].max()) * low
    return least * (1 - np.sign(least) * 1e-9) - 1, most * (1 + np.sign(most) * 1e-9) + 1


def overlap(norm, angle, ring, least_wanted) -> tuple[int, int]:
    """The part of a ring, by its sorted angles, that can reach the least wanted score of
    any of these anchors."""
    cos = np.clip((least_wanted - 1) / np.maximum(norm * ring["norm"].max(), 1e-300), -1, 1)
    wide = np.where(least_wanted <= 0, np.pi, np.arccos(cos)) + SLACK
    own = angle[:, ring["cell"]]
    return (int(np.searchsorted(ring["angle"], (own - wide).min(), side="left")),
            int(np.searchsorted(ring["angle"], (own + wide).max(), side="right")))


def first_rows(score: np.ndarray, ids: list, count: int) -> list:
    """The first ``count`` (score, id, class) by falling score, then id."""
    if len(score) > count:
        at = np.flatnonzero(score >= np.partition(score, len(score) - count)[len(score) - count])
    else:
        at = np.arange(len(score))
    return sorted(((int(score[i]), x, int(i)) for i in at for x in ids[i][:count]), key=lambda r: (-r[0], r[1]))[:count]


def merged(old: list, new: list, count: int) -> list:
    return sorted(old + new, key=lambda r: (-r[0], r[1]))[:count] if old and new else (old or new)


def _vector_rows(scale: int):
    def go(batches):
        for batch in batches:
            keep, k0, k1, dim, q = [], [], [], [], []
            for i, value in enumerate(batch.column(3)):
                v = quantised(value, scale)
                if v is not None:
                    keep.append(i)
                    a, b = np.frombuffer(xxhash.xxh3_128_digest(v.tobytes()), np.int64).tolist()
                    k0.append(a)
                    k1.append(b)
                    dim.append(len(v))
                    q.append(v)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(3)), pa.array(k0, pa.int64()), pa.array(k1, pa.int64()), pa.array(dim, pa.int32()),
                 pa.array(q, pa.list_(pa.int32()))], names=["vec_id", "label", "anchor", "k0", "k1", "dim", "q"])
    return go


def _placed_rows(references: dict):
    """Adds the nearest reference and the angle to it, by which rings are laid out."""
    def go(batches):
        for batch in batches:
            cell, angle = [], []
            for q in batch.column(batch.schema.get_field_index("q")):
                q = q.values.to_numpy(zero_copy_only=False)[None]
                a = angles(q, references.get(q.shape[1]))[1][0]
                cell.append(int(a.argmin()))
                angle.append(float(a.min()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(angle, pa.float64())],
                                             names=[*batch.schema.names, "cell", "angle"])
    return go


def _packed(most: int, same: tuple, columns: dict):
    """Sorted rows put together, up to ``most`` alike in the columns ``same``: one row
    (pack, then label, dim and cell, then ``q`` as bytes and the columns as lists)."""
    def batch_of(held, pack):
        q = np.array([x["q"] for x in held], np.int32)
        first = held[0]
        return pa.RecordBatch.from_arrays(
            [pa.array([pack], pa.int64()), pa.array([first["label"]], pa.string()), pa.array([first["dim"]], pa.int32()),
             pa.array([first["cell"]], pa.int32()), pa.array([q.tobytes()], pa.binary()),
             *(pa.array([[x[c] for x in held]], pa.list_(t)) for c, t in columns.items())],
            names=["pack", "label", "dim", "cell", "q", *columns])

    def go(batches):
        from pyspark import TaskContext
        pack, held = TaskContext.get().partitionId() << 33, []
        for batch in batches:
            for x in batch.to_pylist():
                if held and (len(held) == most or any(x[c] != held[0][c] for c in same)):
                    yield batch_of(held, pack)
                    pack, held = pack + 1, []
                held.append(x)
        if held:
            yield batch_of(held, pack)
    return go


def _unpacked(x: dict, references: dict) -> dict:
    q = np.frombuffer(x["q"], np.int32).reshape(-1, x["dim"])
    norm, angle = angles(q, references.get(x["dim"]))
    return {"label": x["label"], "dim": x["dim"], "cell": x["cell"], "q": q, "norm": norm, "angles": angle}


def _ring(x: dict, references: dict) -> dict:
    r = _unpacked(x, references)
    return r | {"ids": x["ids"], "keys": list(zip(x["k0"], x["k1"], strict=True)), "lo": r["angles"].min(axis=0),
                "hi": r["angles"].max(axis=0), "angle": r["angles"][:, r["cell"]]}


def positives_of(block: dict, rings: list, count: int) -> list:
    """Of each anchor of a block the first ``count`` rows of the rings of its label:
    (score, id, whether it is of the anchor's own class)."""
    n = len(block["q"])
    top: list[list] = [[] for _ in range(n)]
    worst = np.full(n, -np.inf)
    bounds = [score_bounds(block["norm"], block["angles"], r)[1] for r in rings]
    for k in sorted(range(len(rings)), key=lambda k: -bounds[k].max()):
        ring = rings[k]
        live = np.flatnonzero(bounds[k] >= worst)
        if not len(live):
            continue
        a, b = overlap(block["norm"][live], block["angles"][live], ring, worst[live])
        if a >= b:
            continue
        s = scores(block["q"][live], ring["q"][a:b])
        for i, row in zip(live[s.max(axis=1) >= worst[live]], s[s.max(axis=1) >= worst[live]], strict=True):
            new = [(sc, x, ring["keys"][a + c] == block["keys"][i]) for sc, x, c in first_rows(row, ring["ids"][a:b], count)]
            top[i] = merged(top[i], new, count)
            if len(top[i]) == count:
                worst[i] = top[i][-1][0]
    return top


def negatives_of(block: dict, rings: list, count: int, percent: tuple) -> list:
    """Of each anchor of a block and each of its positive scores p the first ``count``
    rows of the rings of other labels with percent[0] * p <= 100 * score <=
    percent[1] * p: one dict an anchor, by p."""
    lo = [[-((-percent[0] * p) // 100) for p in ps] for ps in block["scores"]]
    hi = [[(percent[1] * p) // 100 for p in ps] for ps in block["scores"]]
    top: list[dict] = [{p: [] for p in ps} for ps in block["scores"]]
    # what a score must reach to be of use, and what it must not pass
    worst = np.array([min(x, default=np.inf) for x in lo], float)
    most = np.array([max(x, default=-np.inf) for x in hi], float)
    bounds = [score_bounds(block["norm"], block["angles"], r) for r in rings]
    for k in sorted(range(len(rings)), key=lambda k: -bounds[k][1].max()):
        ring, (least, greatest) = rings[k], bounds[k]
        live = np.flatnonzero((greatest >= worst) & (least <= most))
        if not len(live):
            continue
        a, b = overlap(block["norm"][live], block["angles"][live], ring, worst[live])
        if a >= b:
            continue
        s = scores(block["q"][live], ring["q"][a:b])
        use = ((s >= worst[live][:, None]) & (s <= most[live][:, None])).any(axis=1)
        for i, row in zip(live[use], s[use], strict=True):
            need = []
            for p, low, high in zip(block["scores"][i], lo[i], hi[i], strict=True):
                had = top[i][p]
                low = max(low, had[-1][0]) if len(had) == count else low
                at = np.flatnonzero((row >= low) & (row <= high))
                if len(at):
                    new = [(sc, x) for sc, x, _ in first_rows(row[at], [ring["ids"][a + c] for c in at], count)]
                    had = top[i][p] = merged(had, new, count)
                need.append(max(low, had[-1][0]) if len(had) == count else low)
            worst[i] = min(need)
    return top


def _match(references: dict, out_names: list, emit):
    """Rings of a group are held, then each anchor block of the group meets them."""
    def go(batches):
        group, rings = None, []
        for batch in batches:
            for x in batch.to_pylist():
                if x["grp"] != group:
                    group, rings = x["grp"], []
                if not x["is_block"]:
                    rings.append(_ring(x, references))
                    continue
                block = _unpacked(x, references) | {"keys": list(zip(x["k0"], x["k1"], strict=True)), "scores": x["scores"]}
                rows = emit(block, [r for r in rings if r["dim"] == block["dim"]])
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(out_names)],
                                                 names=[f"c{i}" for i in range(len(out_names))])
    return go


def _positive_rows(references: dict, count: int):
    def emit(block, rings):
        top = positives_of(block, [r for r in rings if r["label"] == block["label"]], count)
        return [(block["label"], *key, s, x, own) for key, rows in zip(block["keys"], top, strict=True) for s, x, own in rows]
    return _match(references, [pa.string(), *[pa.int64()] * 4, pa.bool_()], emit)


def _negative_rows(references: dict, count: int, percent: tuple):
    def emit(block, rings):
        top = negatives_of(block, [r for r in rings if r["label"] != block["label"]], count, percent)
        return [(block["label"], *key, p, s, x) for key, by in zip(block["keys"], top, strict=True) for p, rows in by.items() for s, x in rows]
    return _match(references, [pa.string(), *[pa.int64()] * 5], emit)


def _meet(rings: DataFrame, blocks: DataFrame, n: int, make, schema: str) -> DataFrame:
    """Every anchor block with the rings of each of its groups; both have a column grp,
    the blocks an array of groups."""
    cols = ["grp", "is_block", "pack", "label", "dim", "cell", "q", "k0", "k1", "ids", "scores"]
    a = rings.withColumns({"is_block": F.lit(False), "scores": F.lit(None).cast("array<array<long>>")}).select(*cols)
    b = blocks.withColumns({"grp": F.explode("grp"), "is_block": F.lit(True), "ids": F.lit(None).cast("array<array<long>>")}).select(*cols)
    return a.union(b).repartition(n, "grp").sortWithinPartitions("grp", "is_block", "pack").mapInArrow(make, schema)


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, percent: tuple = (50, 95),
                   scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score. The
    anchors are the rows where ``anchor`` holds. Their positives are the first
    ``positives`` other rows of the label, and for each of them the negatives the first
    ``negatives`` rows of other labels whose score is between ``percent`` of the
    positive's. Scores are integer inner products of the components' floor(scale * x);
    higher ones come first, ties by smaller id. A pair without such a row gives none.
    Rows with a null id, label or vector, or any null or non-finite component take no
    part, nor do those whose quantised norm is 2^31 or more (scores would not fit a
    long); vectors of different lengths never meet. Repeated rows are rows of their own.
    Extra columns aren't read. The references come from SAMPLE classes; they decide what
    is scored, not what is returned."""
    spark = vectors.sparkSession
    n = partitions(spark)
    rows = store(vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                                F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
                 .filter("vec_id is not null and label is not null and size(v) > 0")
                 .mapInArrow(_vector_rows(scale), "vec_id long, label string, anchor boolean, k0 long, k1 long, dim int, q array<int>"))
    key = ["label", "k0", "k1"]
    # of a class more ids than a list has places can't be in it, the anchor's own put aside
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("vec_id"))
    classes = store(rows.select(*key, "dim", "q", "vec_id").withColumn("nth", nth).filter(F.col("nth") <= max(positives + 1, negatives))
                    .groupBy(*key).agg(F.first("dim").alias("dim"), F.first("q").alias("q"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    by_dim: dict[int, list] = {}
    for r in classes.orderBy("k0", "k1", "label").limit(SAMPLE).select("q").collect():
        by_dim.setdefault(len(r["q"]), []).append(r["q"])
    references = {d: spread_out(sample, REFERENCES) for d, sample in by_dim.items()}

    def packs(df, most, same, **columns):
        placed = df.mapInArrow(_placed_rows(references), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema) + ", cell int, angle double")
        types = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
        order = ["label", "dim", "cell", "angle", "k0", "k1"]
        return store(placed.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(
            _packed(most, same, {c: types[t] for c, t in columns.items()}),
            "pack long, label string, dim int, cell int, q binary, " + ", ".join(f"{c} array<{t}>" for c, t in columns.items())))

    rings = packs(classes, RING, ("label", "dim", "cell"), k0="long", k1="long", ids="array<long>")
    asked = store(rows.filter("anchor").select("vec_id", *key))
    anchors = store(asked.select(*key).distinct().withColumnsRenamed({c: f"_{c}" for c in key})
                    .join(classes, [F.col(f"_{c}") == F.col(c) for c in key]).select(*key, "dim", "q"))
    none = F.array().cast("array<long>")
    blocks = packs(anchors.withColumn("scores", none), ANCHORS, ("label", "dim"), k0="long", k1="long", scores="array<long>")
    # a label's rings in groups of its own for the positives, all rings together for the negatives
    sizes = store(rings.groupBy(F.col("label").alias("_label")).agg(F.ceil(F.count(F.lit(1)) / RINGS).cast("int").alias("groups")))
    own = rings.join(sizes, rings["label"] == sizes["_label"]).withColumn(
        "grp", F.concat_ws(":", F.pmod(F.xxhash64("pack"), "groups"), "label"))
    every = blocks.join(sizes, blocks["label"] == sizes["_label"]).withColumn(
        "grp", F.transform(F.sequence(F.lit(0), F.col("groups") - 1), lambda g: F.concat_ws(":", g, F.col("label"))))
    c = [f"c{i}" for i in range(6)]
    found = _meet(own, every, n, _positive_rows(references, positives + 1), "c0 string, c1 long, c2 long, c3 long, c4 long, c5 boolean")
    nth = F.row_number().over(Window.partitionBy(*c[:3]).orderBy(F.desc("c3"), "c4", F.desc("c5")))
    best = store(found.withColumn("nth", nth).filter(F.col("nth") <= positives + 1).groupBy(*c[:3])
                 .agg(F.sort_array(F.collect_list(F.struct("nth", F.col("c3").alias("score"), F.col("c4").alias("id"), F.col("c5").alias("own")))).alias("best")))
    joined = asked.join(best, (asked["label"] == best["c0"]) & (asked["k0"] == best["c1"]) & (asked["k1"] == best["c2"]))
    itself = F.array_position(F.transform("best", lambda b: b["own"] & (b["id"] == F.col("vec_id"))), True)
    others = F.slice(F.filter("best", lambda b, i: i != F.col("itself") - 1), 1, positives)
    pairs = store(joined.withColumn("itself", itself).select("vec_id", *key, F.posexplode(others).alias("nth", "p"))
                  .select("vec_id", *key, "nth", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")))
    wanted = pairs.groupBy(*[F.col(x).alias(f"_{x}") for x in key]).agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    again = store(anchors.join(wanted, [F.col(x) == F.col(f"_{x}") for x in key]).select(*key, "dim", "q", "scores"))
    blocks = packs(again, ANCHORS, ("label", "dim"), k0="long", k1="long", scores="array<long>")
    groups = -(-max(1, rings.count()) // RINGS)
    mixed = rings.withColumn("grp", F.pmod(F.xxhash64("pack"), F.lit(groups)).cast("string"))
    to_all = blocks.withColumn("grp", F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: g.cast("string")))
    found = _meet(mixed, to_all, n, _negative_rows(references, negatives, percent), "c0 string, c1 long, c2 long, c3 long, c4 long, c5 long")
    nth = F.row_number().over(Window.partitionBy(*c[:4]).orderBy(F.desc("c4"), "c5"))
    hard = store(found.withColumn("rank", nth).filter(F.col("rank") <= negatives))
    same = ((pairs["label"] == hard["c0"]) & (pairs["k0"] == hard["c1"]) & (pairs["k1"] == hard["c2"])
            & (pairs["positive_score"] == hard["c3"]))
    return pairs.join(hard, same).select(
        F.col("vec_id").alias("anchor_id"), "positive_id", "rank", F.col("c5").alias("negative_id"), "positive_score",
        F.col("c4").alias("negative_score"))
