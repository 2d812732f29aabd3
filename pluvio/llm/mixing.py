"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``max_copies`` that give each source its target
number of tokens, the ones closest in relative entropy to taking every document once
are min(max_copies, exp(lambda_s * size)): the dual has one multiplier a source, and
its gradient and Hessian are sums over documents. They are computed by Spark over the
distinct (source, size) pairs, and Newton steps, kept inside a bracket, run until each
source meets its target. Rates become whole copies by comparing a hash of the document
with the rate's fraction; a threshold a source, found from histograms of that
comparison, fills the target up to the first document that is too large, further passes
fill the rest with ever smaller ones and then with further copies up to the cap, until
nothing fits. Where a document is so large that going past the target with it, or taking
it alone, comes nearer, that is done instead.
The driver holds a few numbers a source, as it holds the weights themselves. Only
DataFrame functions run on the executors.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import fresh, store, without

WORDS = r"[^\x20\x09-\x0D]+"
STEPS = 100        # Newton and bisection steps at most; a dozen are usual
TOLERANCE = 1e-7   # of a source's target, for rates
BITS = 12          # of a level in one histogram: 4,096 bins a source
LEVELS = 1 << 3 * BITS  # steps of the comparison of hash and fraction
NEAR = 1e-4        # of a target: a source that misses less is left as it is


def word_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORDS))).cast("long")


def cyclic_weights(sources: list, pattern=(5, 2, 1)) -> dict:
    """The pattern dealt over the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: pattern[i % len(pattern)] for i, s in enumerate(ordered)}


def capped_targets(sizes: dict, weights: dict, total: float, cap: float) -> dict:
    """``total`` shared by weight; no target above ``cap`` times its source's size, the
    excess reshared by weight among the others until none is above."""
    targets, open_ = {}, [s for s in sizes if weights.get(s, 0) > 0]
    targets = {s: 0.0 for s in sizes}
    left = total
    while open_:
        w = sum(weights[s] for s in open_)
        above = [s for s in open_ if left * weights[s] / w > cap * sizes[s]]
        if not above:
            for s in open_:
                targets[s] = left * weights[s] / w
            break
        for s in above:
            targets[s] = float(cap * sizes[s])
        left -= sum(cap * sizes[s] for s in above)
        open_ = [s for s in open_ if s not in above]
    return targets


def _key(source: Column) -> Column:
    """A source's name in the per-source tables; null has one of its own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def _name(source) -> str:
    return "null" if source is None else f"={source}"


def _of(values: dict, key: Column, kind: str = "double") -> Column:
    """The value of a row's source, from a literal map (one entry a source)."""
    if not values:
        return F.lit(None).cast(kind)
    pairs = [x for k, v in values.items() for x in (F.lit(k), F.lit(v).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), key)


@dataclass
class Mixture:
    """What is fitted: by source its size, target and multiplier, and the rounding. A pass
    is (stage, thresholds, largest sizes): it gives one copy more to the documents below
    the source's threshold that are no larger, where that is within the cap in its stage.
    ``past``: (size, level, stage) of a document that goes past the target; ``alone``:
    (size, draw) of a source's only document taken."""
    sizes: dict
    targets: dict
    multipliers: dict
    max_copies: int
    passes: list = field(default_factory=list)
    past: dict = field(default_factory=dict)
    alone: dict = field(default_factory=dict)

    def rate(self, key: Column, size: Column) -> Column:
        lam = _of(self.multipliers, key)
        top = math.log(self.max_copies)
        tilted = F.exp(F.least(lam * size, F.lit(top + 1)))
        full = _of({k: 1.0 for k, t in self.targets.items() if t >= self.max_copies * self.sizes[k]}, key).isNotNull()
        none = _of({k: 1.0 for k, t in self.targets.items() if t <= 0}, key).isNotNull()
        # past the cap by rounding only, a rate is the cap itself
        cap = F.lit(float(self.max_copies))
        return F.when(full, cap).when(none, F.lit(0.0)).otherwise(F.least(cap, tilted))

    def level(self, rate: Column, draw: Column) -> Column:
        """When a document's next copy is due: below LEVELS/2 if its hash is below the
        fraction. Null when it has all copies or no rate."""
        frac = rate - F.floor(rate)
        return F.when((rate < self.max_copies) & (rate > 0),
                      F.floor((draw - frac + 1) * (LEVELS // 2)).cast("long"))

    def due(self, stage: int, key: Column, size: Column, level: Column) -> Column:
        """Whether a pass of this stage takes the document."""
        due = F.lit(False)
        for at, thresholds, largest in self.passes:
            if at == stage:
                due = due | ((level < _of(thresholds, key, "long")) & (size <= _of(largest, key, "long")))
        past = {k: v for k, v in self.past.items() if v[2] == stage}
        if past:
            due = due | ((size == _of({k: v[0] for k, v in past.items()}, key, "long"))
                         & (level == _of({k: v[1] for k, v in past.items()}, key, "long")))
        return F.coalesce(due, F.lit(False))

    def copies(self, key: Column, size: Column, draw: Column) -> Column:
        rate = self.rate(key, size)
        level, base = self.level(rate, draw), F.floor(rate).cast("int")
        got = base
        for stage in range(1, self.max_copies + 1):
            got = got + (self.due(stage, key, size, level) & (base + stage <= self.max_copies)).cast("int")
        if not self.alone:
            return got
        chosen = _of({k: v[0] for k, v in self.alone.items()}, key, "long")
        same = (size == chosen) & (draw == _of({k: v[1] for k, v in self.alone.items()}, key))
        return F.when(chosen.isNotNull() & (size > 0), same.cast("int")).otherwise(got)


def draw_of(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _newton(pairs: DataFrame, sizes: dict, targets: dict, n: dict, max_copies: int) -> dict:
    """Multipliers by source. ``pairs``: key, size, n."""
    lam = {k: 0.0 for k in sizes if 0 < targets[k] < max_copies * sizes[k]}
    low, high = {k: -math.inf for k in lam}, {k: math.inf for k in lam}
    open_ = set(lam)
    top = math.log(max_copies)
    for _ in range(STEPS):
        if not open_:
            break
        x = F.col("size").cast("double")
        e = _of({k: lam[k] for k in sorted(open_)}, F.col("key")) * x
        rate = F.exp(F.least(e, F.lit(top)))
        sums = (pairs.filter(F.col("key").isin(sorted(open_)) & (F.col("size") > 0)).groupBy("key")
                .agg(F.sum(F.col("n") * x * rate).alias("g"),
                     F.sum(F.when(e < top, F.col("n") * x * x * rate).otherwise(0.0)).alias("h")).collect())
        for row in sums:
            k, g, h = row["key"], row["g"], row["h"]
            gap = g - targets[k]
            if abs(gap) <= TOLERANCE * targets[k]:
                open_.discard(k)
                continue
            if gap > 0:
                high[k] = min(high[k], lam[k])
            else:
                low[k] = max(low[k], lam[k])
            unit = n[k] / sizes[k]  # one over the mean size
            step = lam[k] - gap / h if h > 0 else math.inf * -gap
            if not low[k] < step < high[k] or not math.isfinite(step):
                if math.isinf(low[k]):
                    step = 2 * min(lam[k], -unit)
                elif math.isinf(high[k]):
                    step = 2 * max(lam[k], unit)
                else:
                    step = (low[k] + high[k]) / 2
            if step == lam[k] or (low[k] >= math.nextafter(high[k], -math.inf)):
                open_.discard(k)
            lam[k] = float(f"{step:.12g}")
    return lam


def _first_too_large(open_: DataFrame, need: dict) -> tuple[dict, dict]:
    """By source the level up to which the documents of ``open_`` fit what is needed, and
    their words. The level is found by histograms, each of one bin of the one before."""
    base, got = dict.fromkeys(need, 0), dict.fromkeys(need, 0)
    top = LEVELS >> 2 * BITS
    for shift in (2 * BITS, BITS, 0):
        inside = F.lit(True) if shift == 2 * BITS else (
            F.expr(f"shiftright(level, {shift + BITS})") == _of({k: v >> shift + BITS for k, v in base.items()}, F.col("key"), "long"))
        bin_ = F.expr(f"shiftright(level, {shift})") - _of({k: v >> shift for k, v in base.items()}, F.col("key"), "long")
        bins = open_.filter(inside).groupBy("key", bin_.alias("bin")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        room = _of({k: need[k] - got[k] for k in need}, F.col("key"))
        filled = bins.withColumn("upto", F.sum("words").over(upto)).withColumn("room", room)
        crossing = {r["key"]: r for r in filled.groupBy("key").agg(
            F.min(F.when(F.col("upto") > F.col("room"), F.col("bin"))).alias("bin"),
            F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))).alias("words")).collect()}
        for k in need:
            row = crossing.get(k)
            base[k] += (top if row is None or row["bin"] is None else row["bin"]) << shift
            got[k] += (row and row["words"]) or 0
        top = 1 << BITS
    return base, got


def _rounding(rows: DataFrame, mix: Mixture, left: dict) -> None:
    """Adds the rounding to ``mix``. ``rows``: key, size, base (whole part of the rate),
    draw, level (of documents whose next copy is open); ``left``: words still to be taken
    by source. Each pass raises the threshold of documents no larger than what is left, as
    far as they fit; when nothing does, the next stage gives documents another copy."""
    def open_in(stage):
        return rows.filter((F.col("base") + stage <= mix.max_copies) & ~mix.due(stage, F.col("key"), F.col("size"), F.col("level")))

    for stage in range(1, mix.max_copies + 1):
        largest, busy = dict.fromkeys(left, 1 << 62), set(left)
        while need := {k: left[k] for k in busy if left[k] >= max(1.0, NEAR * mix.targets[k])}:
            base, got = _first_too_large(open_in(stage).filter(F.col("size") <= _of({k: largest[k] for k in need}, F.col("key"), "long")), need)
            mix.passes.append((stage, base, {k: largest[k] for k in need}))
            for k in need:
                left[k] -= got[k]
                if not got[k] and largest[k] <= left[k]:
                    busy.discard(k)  # nothing was taken of what fits
                largest[k] = int(left[k])
    short = {k: v for k, v in left.items() if v >= max(1.0, NEAR * mix.targets[k])}
    if not short:
        return
    own = rows.filter(F.col("key").isin(sorted(short)))
    for stage in range(1, mix.max_copies + 1):  # the smallest copy that is still open
        for r in (open_in(stage).filter(F.col("key").isin(sorted(short))).groupBy("key")
                  .agg(F.min(F.struct("size", "level")).alias("x")).collect()):
            had = mix.past.get(r["key"])
            if had is None or r["x"]["size"] < had[0]:
                mix.past[r["key"]] = (r["x"]["size"], r["x"]["level"], stage)
    mix.past = {k: v for k, v in mix.past.items() if v[0] - short[k] < short[k]}
    miss = {k: mix.past[k][0] - short[k] if k in mix.past else short[k] for k in short}
    gap = F.abs(F.col("size") - _of({k: mix.targets[k] for k in short}, F.col("key")))
    for r in own.groupBy("key").agg(F.min(F.struct(gap.alias("gap"), "size", "draw")).alias("x")).collect():
        if r["x"]["gap"] < miss[r["key"]]:
            mix.alone[r["key"]] = (r["x"]["size"], r["x"]["draw"])
            mix.past.pop(r["key"], None)


def numbered(rows: DataFrame, same: str, out: str) -> DataFrame:
    """``rows``, stored, with a number for each row among those that are alike in ``same``:
    0, 1 and so on, whichever row gets which. A row is counted within its partition and
    the partitions are added up, so a group of any size is counted in many tasks."""
    (part, before, its) = fresh(rows, "part", "before", "its")
    t = store(rows.withColumn(part, F.spark_partition_id()))
    counts = t.groupBy(same, part).agg(F.count(F.lit(1)).alias("c"))
    if counts.groupBy(same).agg(F.sum("c").alias("c")).filter("c > 1").isEmpty():
        return t.drop(part).withColumn(out, F.lit(0).cast("long"))
    # a row for each partition that holds the value
    earlier = Window.partitionBy(same).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = store(counts.withColumn(before, F.coalesce(F.sum("c").over(earlier), F.lit(0)))
                    .select(F.col(same).alias(its), F.col(part).alias(f"_{part}"), before))
    nth = F.row_number().over(Window.partitionBy(same, part).orderBy(same))
    return store(t.withColumn(out, nth).join(offsets, (F.col(same) == F.col(its)) & (F.col(part) == F.col(f"_{part}")))
                 .withColumn(out, F.col(out) - 1 + F.col(before)).drop(part, f"_{part}", before, its))


def with_draws(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "draw") -> DataFrame:
    """``docs``, stored without the text, plus ``draw``: a number in [0, 1) by identifier
    and text, and for repeated rows by the number among them."""
    same, number = fresh(docs, "same", "number")
    rows = docs.withColumn(same, F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))).drop(text_col)
    return numbered(rows, same, number).withColumn(out, draw_of(F.col(same), F.col(number))).drop(same, number)


def fit_stored(docs: DataFrame, source_col: str = "source", **options) -> tuple[Mixture, DataFrame]:
    """The mixture of ``docs`` (columns size, draw and the source), and the stored rows
    that it was fitted on."""
    rows = store(docs)
    return fit(rows.select(_key(F.col(f"`{source_col}`")).alias("key"), "size", "draw"), **options), rows


def mix_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it; all columns kept.
    Nulls: a null source is a source, a null text has no words and, with no rate to
    tilt, stays once. Rows alike in identifier and text are drawn one by one."""
    same, number, copy = fresh(docs, "same", "number", "copy")
    alike = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    if docs.groupBy(alike.alias(same)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        rows, nth = docs, F.lit(0).cast("long")
    else:
        rows, nth = numbered(docs.withColumn(same, alike), same, number), F.col(number)
    size, draw = word_count(F.col(f"`{text_col}`")), draw_of(alike, nth)
    mix, _ = fit_stored(rows.select(F.col(f"`{source_col}`"), size.alias("size"), draw.alias("draw")), source_col, **options)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    # a lambda's argument is worked out once, however often the rate refers to it
    about = F.array(F.struct(_key(F.col(f"`{source_col}`")).alias("key"), size.alias("size"), draw.alias("draw")))
    copies = F.get(F.transform(about, lambda d: mix.copies(d["key"], d["size"], d["draw"])), F.lit(0))
    return rows.select(*cols, F.explode(F.array_repeat(F.lit(0), copies)).alias(copy)).drop(copy)


def fit(sized: DataFrame, weights=cyclic_weights, share: float = 1.5, max_copies: int = 2) -> Mixture:
    """The mixture of ``sized`` (columns key, size, draw, stored). ``weights``:
    a dict by source, or a function of the list of sources; targets share ``share``
    times all words by weight, at most ``max_copies`` times a source's own. A source's
    taken words miss its target by less than NEAR of it or less than the smallest document
    of which more could be taken, unless a single document decides (see the module)."""
    pairs = store(sized.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = pairs.groupBy("key").agg(F.sum(F.col("n") * F.col("size")).alias("words"), F.sum("n").alias("n")).collect()
    sizes = {r["key"]: r["words"] for r in totals}
    names = {k: None if k == "null" else k[1:] for k in sizes}
    w = weights(list(names.values())) if callable(weights) else weights
    targets = capped_targets(sizes, {k: w.get(v, 0) for k, v in names.items()}, share * sum(sizes.values()), max_copies)
    lam = _newton(pairs, sizes, targets, {r["key"]: r["n"] for r in totals}, max_copies)
    mix = Mixture(sizes, targets, lam, max_copies)
    key, size = F.col("key"), F.col("size")
    rows = sized.withColumn("rate", mix.rate(key, size)).withColumn("level", mix.level(F.col("rate"), F.col("draw")))
    sure = {r["key"]: r["words"] for r in rows.groupBy("key").agg(F.sum(F.floor("rate") * size).alias("words")).collect()}
    rounded = store(rows.filter(F.col("level").isNotNull() & (size > 0))
                    .select("key", "size", F.floor("rate").cast("int").alias("base"), "draw", "level"))
    _rounding(rounded, mix, {k: targets[k] - sure[k] for k in sizes})
    return mix


def apply(docs: DataFrame, mix: Mixture, size: Column, draw: Column, source_col: str = "source") -> DataFrame:
    """``docs`` plus size, source_size, target, rate, copies and taken (copies times
    size), as expressions: no join. Extra columns of these names are replaced."""
    key = _key(F.col(f"`{source_col}`"))
    rows = docs.withColumns({"_key": key, "_size": size, "_draw": draw})
    got = rows.withColumns({
        "_source_size": _of(mix.sizes, F.col("_key"), "long"), "_target": _of(mix.targets, F.col("_key")),
        "_rate": mix.rate(F.col("_key"), F.col("_size")),
        "_copies": mix.copies(F.col("_key"), F.col("_size"), F.col("_draw"))})
    new = ("size", "source_size", "target", "rate", "copies")
    return (without(got, *new, "taken").withColumnsRenamed({f"_{c}": c for c in new}).drop("_key", "_draw")
            .withColumn("taken", F.col("copies") * F.col("size")))
