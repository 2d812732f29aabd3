"""Near-dedup by min-max hashing.

Each hash function gives two signature values, the smallest and the largest image of
the document's shingles; both agree between two documents with the probability of
their Jaccard similarity, so half the hash evaluations make the same signature.
Bands of values send documents to buckets. Documents with equal shingle sets are one
class from the start. In a bucket every class is first compared with the bucket's
smallest (each with the one it shares most buckets with); classes that this joins are
done with each other. Where a bucket still holds several components, its classes are
compared in blocks across components: a block of sets becomes a 0/1 matrix, and a
matrix product counts the intersections exactly, so no row is made for a pair. Every
link is confirmed on full shingle sets; components come from distributed rounds.
"""
from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import connected_components, local_roots, partitions, store

ROWS = 6            # values in a band: the smallest and the largest of three hashes
MISS = 1e-7         # chance that a pair at the threshold shares no band
CHUNK = 512         # shingles hashed at once
CACHE = 100_000     # words whose hash a task remembers
TOGETHER = 256      # pairs with one partner in a verification group
BLOCK = 256         # sets of a block at most, about
BLOCK_SHINGLES = 100_000  # and shingles in them
COLUMNS = 4096      # shingles whose matrix is held at once


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _WordHash(dict):
    def __missing__(self, word):
        if len(self) > CACHE:
            self.clear()
        self[word] = got = xxhash.xxh3_64_intdigest(word)
        return got


def shingle_set(text: str | None, k: int, words: dict) -> np.ndarray:
    """The distinct k-word shingles as sorted 64-bit hashes: A-Z lower-cased, words
    between ASCII white space; fewer words make one shingle, none an empty set."""
    # bytes know no letters and no white space but those of ASCII
    found = text.encode().lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter((words[w] for w in found), np.uint64, len(found))
    n = max(1, len(h) - k + 1)
    with np.errstate(over="ignore"):
        out = np.full(n, min(k, len(h)), np.uint64)
        for j in range(min(k, len(h))):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n])
    return np.unique(out)


class MinMax:
    """Bands of shingle sets for a similarity threshold."""

    def __init__(self, threshold: float, rows: int = ROWS, miss: float = MISS, seed: int = 1):
        # a band misses a pair at the threshold with 1 - t^rows; two values of one hash
        # agree a little less often together in small sets, hence one row more
        self.bands = math.ceil(math.log(miss) / math.log(1 - threshold ** (rows + 0.5)))
        self.rows = rows
        self.hashes = self.bands * rows // 2
        rng = np.random.default_rng(seed)
        self.mul = rng.integers(0, 2**64, self.hashes, dtype=np.uint64) | np.uint64(1)
        self.add = rng.integers(0, 2**64, self.hashes, dtype=np.uint64)

    def values(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(self.hashes, 2**64 - 1, np.uint64)
        high = np.zeros(self.hashes, np.uint64)
        with np.errstate(over="ignore"):
            for at in range(0, len(shingles), CHUNK):
                image = shingles[at:at + CHUNK, None] * self.mul + self.add
                np.minimum(low, image.min(axis=0), out=low)
                np.maximum(high, image.max(axis=0), out=high)
        return np.stack([low, high], axis=1).reshape(-1)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """A bucket for each band."""
        v = _mix(self.values(shingles))
        with np.errstate(over="ignore"):
            key = np.arange(1, self.bands + 1, dtype=np.uint64)
            for j in range(self.rows):
                key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + v[j::self.rows])
        return key.view(np.int64)


def signatures(docs: DataFrame, k: int, model: MinMax, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, k0 and k1 (the set's digest) and bands; stored."""
    schema = "doc_id long, n_shingles long, k0 long, k1 long, bands array<long>"

    def go(batches):
        words = _WordHash()
        for batch in batches:
            n, digest, bands = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), k, words)
                n.append(len(s))
                digest.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                bands.append(model.keys(s) if len(s) else None)
            k01 = np.array(digest).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(k01[:, 0]), pa.array(k01[:, 1]),
                 pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n_shingles", "k0", "k1", "bands"])

    return store(docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string"))
                 .mapInArrow(go, schema))


def confirmed(texts: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent *
    union. ``texts``: doc, text. Each text is sent once for every pair of its own; a
    partner b with many pairs is sent to several groups of them."""
    pairs = store(pairs)
    many = store(pairs.groupBy(F.col("b").alias("_b")).agg(F.ceil(F.count(F.lit(1)) / TOGETHER).cast("long").alias("salts")))
    dealt = (pairs.join(many, pairs["b"] == many["_b"])
             .select(F.col("b").alias("grp"), F.pmod(F.xxhash64("a"), "salts").alias("salt"), F.col("a").alias("id"),
                     F.lit(True).alias("member")))
    partners = many.select(F.col("_b").alias("grp"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"),
                           F.col("_b").alias("id"), F.lit(False).alias("member"))
    wanted = store(dealt.union(partners))
    rows = (wanted.hint("merge").join(texts, wanted["id"] == texts["doc"]).select("grp", "salt", "member", "doc", "text")
            .repartition(partitions(texts.sparkSession), "grp", "salt")
            .sortWithinPartitions("grp", "salt", "member", "doc"))

    def go(batches):
        words, group, partner = _WordHash(), None, []
        for batch in batches:
            linked = []
            for grp, salt, member, doc, text in zip(*[batch.column(i) for i in range(5)], strict=True):
                key = (grp.as_py(), salt.as_py())
                if key != group:
                    group, partner = key, []
                s = shingle_set(text.as_py(), k, words)
                if not member.as_py():
                    if not any(np.array_equal(s, p) for p in partner):  # rows that share the id
                        partner.append(s)
                    continue
                for p in partner:
                    if 100 * min(len(s), len(p)) < percent * max(len(s), len(p)):
                        continue
                    both = len(np.intersect1d(s, p, assume_unique=True))
                    if both and 100 * both >= percent * (len(s) + len(p) - both):
                        linked.append((doc.as_py(), key[0]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in linked], pa.int64()),
                                              pa.array([x[1] for x in linked], pa.int64())], names=["a", "b"])

    return store(rows.mapInArrow(go, "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``. Linked are
    documents with 100 * intersection >= percent * union of their k-word shingle sets;
    component_id is the smallest doc_id reachable, kept is doc_id = component_id. Null or
    blank texts link with nothing. A row with a null id links with nothing and is kept,
    with a null component. Rows that share an id count as one document for links; rows
    alike in id and text have the same component. Extra columns aren't read."""
    model = MinMax(percent / 100, rows, miss)
    sig = signatures(docs, k, model, id_col, text_col)
    # documents with equal sets are one class, known by its smallest id
    classes = store(sig.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).groupBy("k0", "k1").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    placed = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = store(placed.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("c"))
                    .filter("c > 1").select(F.col("bucket").alias("_bucket"), "hub"))
    members = store(placed.join(buckets, placed["bucket"] == buckets["_bucket"]).select("bucket", "rep", "hub"))
    # each with the bucket-smallest class that it meets most often
    votes = members.filter("rep <> hub").groupBy("rep", "hub").agg(F.count(F.lit(1)).alias("c"))
    first = votes.groupBy("rep").agg(F.max(F.struct("c", (-F.col("hub")).alias("hub"))).alias("m")).select(
        F.col("rep").alias("a"), (-F.col("m.hub")).alias("b"))
    texts = _texts(docs, members.select("rep").distinct(), id_col, text_col)
    linked = confirmed(texts, first, k, percent)
    rest = _left_over(classes, members, connected_components(linked), percent)
    linked = linked.union(_linked_in_blocks(texts, rest, k, percent))
    comp = connected_components(linked)
    known = store(classes.join(comp, classes["rep"] == comp["id"], "left").select(
        F.col("k0").alias("_k0"), F.col("k1").alias("_k1"), F.coalesce("component", "rep").alias("component_id")))
    found = (F.col("k0") == F.col("_k0")) & (F.col("k1") == F.col("_k1"))
    return (sig.select("doc_id", "n_shingles", "k0", "k1").join(known, found, "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id"))
                           .otherwise(F.col("doc_id"))).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc and text of the documents with these ids, stored: the corpus is shuffled
    once, whatever is compared afterwards. Joined by shuffle at every size, since the
    ids grow with the corpus."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return store(rows.hint("merge").join(ids.hint("merge"), rows["doc"] == ids["rep"], "left_semi"))


def _left_over(classes: DataFrame, members: DataFrame, comp: DataFrame, percent: int) -> DataFrame:
    """Block pairs that cover every pair of a bucket whose classes lie in different
    components and may be similar enough by their sizes: hub, part, i, j, first, rep, comp.
    Buckets of the same hub go together. The classes of a group's largest component are
    compared with the other classes only, so a large group that is joined already costs no
    more than what is not. Set sizes fall into steps of the least ratio that similar sets
    have, so a class meets those of its own step and of the two beside it alone."""
    m = store(members.join(comp, members["rep"] == comp["id"], "left")
              .select("bucket", "hub", "rep", F.coalesce("component", "rep").alias("comp")))
    mixed = store(m.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi")
                  .select(F.col("bucket").alias("_bucket")))
    rest = store(m.join(mixed, m["bucket"] == mixed["_bucket"], "left_semi").select("hub", "rep", "comp").distinct())
    main = store(rest.groupBy("hub", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy(F.col("hub").alias("_hub"))
                 .agg(F.max(F.struct("c", "comp"))["comp"].alias("main")))
    size = classes.select(F.col("rep").alias("_rep"), "n")
    sized = store(rest.join(main, rest["hub"] == main["_hub"]).join(size, rest["rep"] == size["_rep"])
                  .select("hub", "rep", "comp", (F.col("comp") != F.col("main")).alias("odd"), "n"))

    # sets two steps apart differ by more than the threshold allows, rounding included
    step = F.floor(F.log("n") / math.log(100 / percent * (1 + 1e-9))).cast("int") if percent < 100 else F.col("n").cast("int")
    sized = store(sized.withColumn("step", step))

    def blocks(which):
        return F.ceil(F.greatest(F.sum(F.when(which, 1).otherwise(0)) / BLOCK,
                                 F.sum(F.when(which, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("int")
    counts = store(sized.groupBy(F.col("hub").alias("_hub"), F.col("step").alias("_step"))
                   .agg(blocks(F.col("odd")).alias("odds"), blocks(~F.col("odd")).alias("mains")))
    here = (sized["hub"] == counts["_hub"]) & (sized["step"] == counts["_step"])
    dealt = store(sized.join(counts, here).withColumn(
        "own", F.pmod(F.xxhash64("rep"), F.when(F.col("odd"), F.col("odds")).otherwise(F.col("mains"))).cast("int"))
        .select("hub", "step", "rep", "comp", "odd", "own"))

    def meets(odd, other, shift, part, same):
        """The rows with ``odd`` as they are, for each block with ``other`` in the step
        ``shift`` above; the block is i of the lower side's and j of the upper side's."""
        rows = dealt.filter(F.col("odd") if odd else ~F.col("odd"))
        n = counts.select("_hub", (F.col("_step") - shift).alias("_step"), F.col("odds" if other else "mains").alias("_n")).filter("_n > 0")
        met = rows.join(n, (rows["hub"] == n["_hub"]) & (rows["step"] == n["_step"])).withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        lower = F.col("step") if shift >= 0 else F.col("step") + shift
        name = F.concat(F.lit(part), lower.cast("string"))
        if same:
            return met.select("hub", name.alias("part"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                              (F.col("own") <= F.col("other")).alias("first"), "rep", "comp")
        first = shift > 0 or (shift == 0 and odd)
        i, j = ("own", "other") if first else ("other", "own")
        return met.select("hub", name.alias("part"), F.col(i).alias("i"), F.col(j).alias("j"), F.lit(first).alias("first"), "rep", "comp")

    every = [meets(True, True, 0, "odd", True), meets(True, True, 1, "up", False), meets(True, True, -1, "up", False),
             meets(True, False, 0, "main", False), meets(False, True, 0, "main", False),
             meets(True, False, 1, "above", False), meets(False, True, -1, "above", False),
             meets(True, False, -1, "below", False), meets(False, True, 1, "below", False)]
    return store(functools.reduce(DataFrame.union, every))


def intersections(left: list, right: list) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    every = [*left, *right]
    row = np.repeat(np.arange(len(every)), [len(s) for s in every])
    _, at, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    shared = count > 1
    column = (np.cumsum(shared) - 1)[at]
    keep = shared[at]
    row, column = row[keep], column[keep]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.int64)
    for base in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [base, base + COLUMNS])
        m = np.zeros((len(every), COLUMNS), np.float32)
        m[row[a:b], column[a:b] - base] = 1
        out += (m[:len(left)] @ m[len(left):].T).astype(np.int64)
    return out


def _linked_in_blocks(texts: DataFrame, rest: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) that join what the block pairs of ``rest`` have in different
    components: from each block pair a spanning forest of its links."""
    key = ["hub", "part", "i", "j"]
    rows = (rest.hint("merge").join(texts, rest["rep"] == texts["doc"]).select(*key, "first", "rep", "comp", "text")
            .repartition(partitions(texts.sparkSession), *key).sortWithinPartitions(*key, "rep"))

    def go(batches):
        words, group, held = _WordHash(), None, ([], [])

        def links():
            left, right = held
            if group is None:
                return [], []
            if group[1].startswith("odd") and group[2] == group[3]:
                right = left
            if not left or not right:
                return [], []
            n = [np.array([len(x[2]) for x in side]) for side in (left, right)]
            comp = [np.array([x[1] for x in side]) for side in (left, right)]
            both = intersections([x[2] for x in left], [x[2] for x in right])
            hit = (both > 0) & (100 * both >= percent * (n[0][:, None] + n[1] - both)) & (comp[0][:, None] != comp[1])
            a, b = np.nonzero(hit)
            if not len(a):
                return [], []
            ids = [np.array([x[0] for x in side]) for side in (left, right)]
            nodes, roots = local_roots(ids[0][a], ids[1][b])
            return nodes[nodes != roots].tolist(), roots[nodes != roots].tolist()

        def batch_of(got):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["a", "b"])

        for batch in batches:
            for *at, first, rep, comp, text in zip(*[batch.column(i) for i in range(8)], strict=True):
                now = tuple(x.as_py() for x in at)
                if now != group:
                    yield batch_of(links())
                    group, held = now, ([], [])
                held[0 if first.as_py() else 1].append((rep.as_py(), comp.as_py(), shingle_set(text.as_py(), k, words)))
        yield batch_of(links())

    return store(rows.mapInArrow(go, "a long, b long"))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate component, all columns kept. Rows
    go by their id: of two texts under one id both go if one is a copy; rows with a null id
    stay. An empty table stays empty."""
    gone = store(near_duplicates(docs, k, percent, id_col, text_col).filter(~F.col("kept"))
                 .select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(gone, docs[f"`{id_col}`"] == gone["_gone"], "left_anti")
