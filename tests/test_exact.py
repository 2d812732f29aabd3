import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from pluvio.functions import exact


def _means(spark, groups, parts):
    data = [(g, v) for g, vs in groups.items() for v in vs]
    random.Random(parts).shuffle(data)
    df = spark.createDataFrame(data, "g string, v double").repartition(parts)
    agg = df.groupBy("g").agg(*exact.sums("v", "mean"), *exact.sums("v", "total"))
    return {r["g"]: (r["mean"], r["total"]) for r in exact.with_totals(exact.with_means(agg, "mean"), "total").collect()}


def test_means_and_totals(spark):
    rng = random.Random(5)
    groups = {f"g{i}": [rng.choice((-1, 1)) * rng.random() * 10 ** rng.randint(-6, 9) for _ in range(rng.randint(1, 200))] for i in range(60)}
    groups["none"], groups["some"] = [None, None], [None, 0.1, 0.2, None]
    groups["cancel"] = [1e15, 0.1, -1e15, 1e-9, -0.1]
    got = _means(spark, groups, 3)
    for g, vs in groups.items():
        known = [Fraction(v) for v in vs if v is not None]
        if not known:
            assert got[g] == (None, None)
            continue
        total, mean = sum(known), sum(known) / len(known)
        # below 2^-64 a value is cut off
        assert abs(Fraction(got[g][0]) - mean) <= abs(mean) * Fraction(1, 2**52) + Fraction(1, 2**63)
        assert abs(Fraction(got[g][1]) - total) <= abs(total) * Fraction(3, 2**53) + Fraction(len(known), 2**63)


def test_order_plays_no_part(spark):
    rng = random.Random(6)
    groups = {f"g{i}": [rng.uniform(-5, 100) for _ in range(50)] for i in range(40)}
    assert _means(spark, groups, 1) == _means(spark, {g: vs[::-1] for g, vs in groups.items()}, 7)


def test_equal_values_are_their_mean(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1000, 1000) for _ in range(80)] + [0.1, 1 / 3, 1e-5, -0.7, 0.0]
    got = _means(spark, {f"{i}:{n}": [v] * n for i, v in enumerate(values) for n in (1, 3, 7, 49)}, 4)
    for i, v in enumerate(values):
        means = {got[f"{i}:{n}"][0] for n in (1, 3, 7, 49)}
        assert len(means) == 1, v
        assert means == {v} or (abs(v) < 1e-3 and abs(means.pop() - v) <= 2.0 ** -64), v


def test_large_and_non_finite_values(spark):
    inf, nan = float("inf"), float("nan")
    got = _means(spark, {"big": [1e30, 1e30, 5.0], "inf": [inf, 1.0], "nan": [nan, 1.0], "edge": [2.0**31, 1.0, -(2.0**31 - 1)]}, 2)
    assert got["big"] == ((2e30 + 5) / 3, 2e30 + 5) and got["inf"] == (inf, inf)
    assert math.isnan(got["nan"][0]) and math.isnan(got["nan"][1])
    assert got["edge"] == (2 / 3, 2.0)


def test_stays_a_hash_aggregation_in_generated_code(spark):
    df = spark.range(100).select((F.col("id") % 5).alias("g"), (F.col("id") / 7).alias("v"))
    out = exact.with_means(df.groupBy("g").agg(*exact.sums("v", "m")), "m")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("HashAggregate(") == 2
    assert out.columns == ["g", "m"]
