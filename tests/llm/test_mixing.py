import math
import random

import pytest
import reference as ref
from pyspark.sql import functions as F

from pluvio.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def test_documents(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op7_mixing(spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(docs)
    sizes = {}
    for d in docs.values():
        sizes[d["source"]] = sizes.get(d["source"], 0) + len(ref.WORD.findall(d["text"] or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    targets = mixing.capped_targets(sizes, weights, 1.5 * sum(sizes.values()), 2)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        d = docs[r["doc_id"]]
        assert r["size"] == len(ref.WORD.findall(d["text"] or ""))
        assert r["source_size"] == sizes[d["source"]]
        assert r["target"] == pytest.approx(targets[d["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == r["copies"] * r["size"]
        taken[d["source"]] += r["taken"]
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 0.01 * t, s
    # rates are those of the dual: exponential in size up to the cap
    by = {}
    for r in out:
        if 0 < r["rate"] < 2 and r["size"]:
            by.setdefault(docs[r["doc_id"]]["source"], []).append(math.log(r["rate"]) / r["size"])
    assert by
    assert all(max(v) == pytest.approx(min(v), rel=1e-6, abs=1e-12) for v in by.values())
    again = {r["doc_id"]: r["taken"] for r in queries.op7_mixing(spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in out}


def test_capped_targets():
    sizes = {"a": 10, "b": 100, "c": 1000, "d": 0}
    t = mixing.capped_targets(sizes, {"a": 5, "b": 2, "c": 1, "d": 5}, 900.0, 2)
    assert t["a"] == 20
    assert t["d"] == 0
    assert t["b"] == 200
    assert t["c"] == 680
    assert mixing.capped_targets({}, {}, 0.0, 2) == {}


def test_targets_met_for_few_and_uneven_documents(spark):
    rows = [(i, " ".join(["w"] * (1 + i * i % 97)), "abc"[i % 3]) for i in range(600)] + [(1000, " ".join(["w"] * 5000), "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size, draw = mixing.word_count(F.col("text")), mixing.draw_of(F.col("doc_id"))
    mix, stored = mixing.fit_stored(df.select("doc_id", "source", size.alias("size"), draw.alias("draw")),
                                    weights={"a": 3, "b": 0.3, "c": 1}, share=0.9)
    got = mixing.apply(stored, mix, F.col("size"), F.col("draw")).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    for r in got:
        assert abs(r["taken"] - r["target"]) <= 0.01 * r["target"] + 1, r


def test_odd_rows(spark):
    rows = [(1, None, "a", 1), (2, "", "a", 1), (3, "x y", None, 1), (None, "x", "b", 1), (4, "x " * 50_000, "b", 1), (4, "x " * 50_000, "b", 1),
            (5, "y z", "=", 1), (6, "q", "null", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mixing.mix_copies(df)
    assert out.columns == df.columns
    assert all(sum(r == x for r in out.collect()) <= 2 * sum(tuple(x) == y for y in rows) for x in out.collect())
    assert mixing.mix_copies(df.limit(0)).count() == 0
    size, draw = mixing.word_count(F.col("text")), mixing.draw_of(F.col("doc_id"))
    mix, _ = mixing.fit_stored(df.select("source", size.alias("size"), draw.alias("draw")))
    got = mixing.apply(df, mix, size, draw)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "rate", "copies", "taken"]
    by = {(r["doc_id"], r["source"]): r for r in got.collect()}
    assert by[1, "a"]["taken"] == 0
    assert by[3, None]["source_size"] == 2
    assert by[6, "null"]["source_size"] == 1


def _taken(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    docs = mixing.with_draws(df.select("doc_id", "source", "text", mixing.word_count(F.col("text")).alias("size")))
    mix, stored = mixing.fit_stored(docs, **options)
    got = mixing.apply(stored, mix, F.col("size"), F.col("draw"))
    per = {r["source"]: (r["taken"], r["target"]) for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    return per, sorted((r["doc_id"], r["copies"]) for r in got.collect())


def test_repeated_rows_are_drawn_one_by_one(spark):
    rows = [(7, "w " * 100, "a")] * 50 + [(100 + i, "v " * (20 + i % 30), "b") for i in range(400)]
    per, copies = _taken(spark, rows, weights={"a": 1, "b": 7}, share=0.6)
    for taken, target in per.values():
        assert abs(taken - target) <= 100
    assert copies == _taken(spark, rows[::-1], weights={"a": 1, "b": 7}, share=0.6)[1]


def test_one_document_dominates(spark):
    rng = random.Random(1)
    sizes = [int(rng.lognormvariate(4, 3)) + 1 for _ in range(400)]
    rows = [(i, "w " * n, "long") for i, n in enumerate(sizes)] + [(1000 + i, "v " * 50, "even") for i in range(400)]
    share = 0.7
    per, copies = _taken(spark, rows, weights={"long": 1, "even": 1}, share=share)
    taken, target = per["long"]
    top, rest = max(sizes), sum(sizes) - max(sizes)
    # as near as the long document alone, or the others twice, or both
    assert abs(taken - target) <= min(abs(top - target), abs(2 * rest - target) if 2 * rest < target else 1e18)
    assert abs(per["even"][0] - per["even"][1]) <= 50
    assert max(c for _, c in copies) <= 2


def plain_fit(sizes, target, cap=2.0):
    """The multiplier by bisection: sum of size * min(cap, exp(lam * size)) is the target."""
    low, high = -60.0, 60.0
    for _ in range(300):
        lam = (low + high) / 2
        words = sum(s * min(cap, math.exp(min(lam * s, 50))) for s in sizes)
        low, high = (lam, high) if words < target else (low, lam)
    return lam


def test_rates_against_a_plain_dual(spark):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(1, 60), "ab"[i % 2]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = mixing.with_draws(df.select("doc_id", "source", "text", mixing.word_count(F.col("text")).alias("size")))
    mix, stored = mixing.fit_stored(docs, weights={"a": 1, "b": 3}, share=1.1)
    total = sum(len(t.split()) for _, t, _ in rows)
    for s, part in (("a", 0.25), ("b", 0.75)):
        sizes = [len(t.split()) for _, t, x in rows if x == s]
        assert mix.targets[f"={s}"] == pytest.approx(1.1 * total * part)
        lam = plain_fit(sizes, 1.1 * total * part)
        for r in mixing.apply(stored, mix, F.col("size"), F.col("draw")).filter(F.col("source") == s).collect():
            assert r["rate"] == pytest.approx(min(2.0, math.exp(lam * r["size"])), rel=1e-4)
            assert r["copies"] in (math.floor(r["rate"]), math.floor(r["rate"]) + 1, math.floor(r["rate"]) + 2) and r["copies"] <= 2


def test_no_python_in_plan(spark):
    df = queries.op7_mixing(spark, SF)
    assert "Python" not in df._jdf.queryExecution().toString()
