import random

import numpy as np
import pytest
import reference as ref
from pyspark.sql import functions as F

from pluvio.llm import minhash
from pluvio.llm.common import connected_components, store

SF = "/root/testdata/sf0.001"


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_documents_against_all_pairs(spark, k, percent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = ref.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], k, percent)
    assert got(minhash.near_duplicates(docs, k, percent)) == want


def test_chain_of_edits_and_threshold(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    texts, base = [], rng.sample(words, 200)
    for _ in range(60):  # a chain: neighbours are near, the ends are not
        texts.append(" ".join(base))
        base = base[:]
        base[rng.randrange(200)] = rng.choice(words)
    hub = rng.sample(words, 100)
    for i in range(80):  # every copy edited elsewhere
        t = hub[:]
        t[i] = "x%d" % i
        texts.append(" ".join(t))
    # 17 of 20 shingles in common: exactly 85 percent; one less: not linked
    texts += [" ".join(f"a{i}" for i in range(20 + 2 - 3 + 0)), " ".join(f"a{i}" for i in range(22))]
    texts += [" ".join(f"b{i}" for i in range(18)), " ".join(f"b{i}" for i in range(22))]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    want = ref.near_duplicates(docs, 3, 85)
    assert want[141][1] == 140
    assert want[143][1] == 143
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(minhash.near_duplicates(df, 3, 85)) == want


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "one Two", "x"), (5, "ONE two", "x"), (6, "one two", None),
            (None, "one two", "x"), (7, "É a b c", "x"), (8, "é a b c", "x"), (9, "long " * 60000 + "end", "x"),
            (10, "long " * 60000 + "end", "x"), (4, "one Two", "x"), (11, "one\u00a0two", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
                  for r in minhash.near_duplicates(df, 3, 85).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False),
            (6, 1, 4, False), (7, 2, 7, True), (8, 2, 8, True), (9, 2, 9, True), (10, 2, 9, False), (11, 1, 11, True),
            (None, 1, None, True)]
    assert out == sorted(want, key=str)
    kept = minhash.drop_near_copies(df, 3, 85)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 4, 7, 8, 9, 11, None], key=str)
    empty = df.limit(0)
    assert minhash.near_duplicates(empty).count() == 0
    assert minhash.drop_near_copies(empty).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    model = minhash.MinMax(0.85)
    x = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    for same in (500, 800, 950):
        y = np.concatenate([x[:same], rng.integers(0, 2**64, 1000 - same, dtype=np.uint64)])
        agree = (model.values(np.sort(x)) == model.values(np.sort(y))).mean()
        assert abs(agree - same / (2000 - same)) < 0.12
    assert len(set(model.keys(x).tolist())) == model.bands


def test_intersections_of_blocks(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(12)]
    got = minhash.intersections(sets[:5], sets[5:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[5:]] for a in sets[:5]]


def test_group_of_near_copies_below_and_above_the_threshold(spark, monkeypatch):
    """Edited copies of one text, most pairs below the threshold, over many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(250):
        t = base[:]
        for _ in range(rng.randrange(1, 6)):
            t[rng.randrange(120)] = f"x{rng.randrange(40)}"
        docs.append((i, " ".join(t)))
    want = ref.near_duplicates(docs, 3, 85)
    assert len({c for _, c in want.values()}) > 1
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert got(minhash.near_duplicates(df, 3, 85)) == want


def test_miss_bound():
    for t in (0.8, 0.85):
        m = minhash.MinMax(t)
        assert (1 - t ** m.rows) ** m.bands <= minhash.MISS


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(200, 260)] + [
        (rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    want = ref.components({x for p in links for x in p}, links)
    df = store(spark.createDataFrame(links, "a long, b long"))
    assert {r["id"]: r["component"] for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).count() == 0


def test_hub_of_many_sizes(spark):
    """20,000 classes in one bucket that link with nothing: a text is sent to blocks of
    sizes near its own only, and any two sets similar enough by size still meet."""
    n = 20_000
    size = F.floor(F.pow(F.lit(100.0), F.col("rep") / n) * 50).cast("long")
    classes = store(spark.range(n).withColumnRenamed("id", "rep").withColumn("n", size))
    members = store(classes.select(F.lit(1).cast("long").alias("bucket"), "rep", F.lit(0).cast("long").alias("hub")))
    none = store(spark.createDataFrame([], "id long, component long"))
    rest = minhash._left_over(classes, members, none, 80)
    blocks = classes.agg(F.ceil(F.sum("n") / minhash.BLOCK_SHINGLES)).first()[0]
    assert rest.count() < 0.25 * n * blocks
    few = classes.filter("rep % 400 = 0").select("rep", "n").collect()
    own = {}
    for r in rest.filter("rep % 400 = 0").collect():
        own.setdefault(r["rep"], set()).add((r["part"], r["i"], r["j"]))
    for a in few:
        for b in few:
            if a["rep"] < b["rep"] and 100 * a["n"] >= 80 * b["n"]:
                assert own[a["rep"]] & own[b["rep"]], (a, b)
