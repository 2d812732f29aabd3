import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import hard_negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, is_anchor, positives=5, negatives=3, percent=(50, 95)):
    """Counted (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for at, (i, q, label) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(q, p, strict=True)), j, k, other) for k, (j, p, other) in enumerate(good) if len(p) == len(q)]
        near = sorted(((s, j) for s, j, k, other in scored if other == label and k != at), key=lambda x: (-x[0], x[1]))[:positives]
        for ps, pid in near:
            hard = sorted(((s, j) for s, j, _, other in scored if other != label and percent[0] * ps <= 100 * s <= percent[1] * ps),
                          key=lambda x: (-x[0], x[1]))[:negatives]
            for rank, (s, j) in enumerate(hard, 1):
                out[i, pid, rank, j, ps, s] += 1
    return out


def got(df):
    return Counter((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"]) for r in df.collect())


@pytest.mark.parametrize("ring,block", [(512, 256), (16, 7)])
def test_clusters(spark, monkeypatch, ring, block):
    monkeypatch.setattr(hard_negatives, "RING", ring)
    monkeypatch.setattr(hard_negatives, "ANCHORS", block)
    monkeypatch.setattr(hard_negatives, "RINGS", 3)
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((5, 12))
    rows = []
    for i in range(600):
        v = centre[i % 5] * rng.uniform(0.2, 3) + rng.standard_normal(12) * (0.05 + 0.4 * (i % 3 == 0))
        rows.append((i, [float(x) for x in np.round(v, 2)], int(rng.integers(0, 4))))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)] + [(1100 + i, rows[5][1], 9) for i in range(30)]
    rows += [(2000 + i, [0.0] * 12, i % 2) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)) == brute(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.9, 0.1], 1), (1, [1.0, 0.1], 1), (None, [1.0, 0.0], 1), (2, None, 1),
            (3, [], 1), (4, [1.0, None], 2), (5, [nan, 1.0], 2), (6, [0.8, 0.0], 2), (6, [0.8, 0.0], 2), (7, [0.8, 0.0], None),
            (8, [0.7, 0.0, 0.0], 2), (9, [0.9, 0.0], 3), (10, [-1.0, 0.0], 4), (11, [1.0, 0.0, 0.5], 1), (50, [0.0, 0.0], 5)]
    df = spark.createDataFrame([(*r, 7) for r in rows], SCHEMA + ", rank int")
    want = brute(rows, lambda i: i % 50 == 0)
    assert want and got(hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0)) == want
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0


def test_large_components(spark):
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(
        [[3e5, 2e5], [3e5 + 1, 2e5], [2.5e5, 2e5], [2.9e5, 1.7e5], [1e30, 1.0], [1.5e5, 1.5e5 + 0.5]])]
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([r for r in rows if r[0] != 4], lambda i: i % 50 == 0)  # a norm of 2^31 or more takes no part
    assert want and got(hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0)) == want


def test_query(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert got(queries.op11_hard_negatives(spark, SF)) == brute(rows, lambda i: i % 50 == 0)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(7)
    centre = rng.standard_normal((8, 16))
    q = np.array([centre[i % 8] * 200 * rng.uniform(0.5, 2) + rng.standard_normal(16) * 20 for i in range(400)]).astype(np.int32)
    references = {16: hard_negatives.spread_out(q.tolist(), 8)}
    of = hard_negatives.angles(q, references[16])[1].argmin(axis=1)
    block = hard_negatives._unpacked({"q": q[:40].tobytes(), "dim": 16, "label": "a", "cell": 0}, references)
    passed = 0
    for cell in range(8):
        own = q[of == cell]
        order = np.argsort(hard_negatives.angles(own, references[16])[1][:, cell])
        ring = hard_negatives._ring({"q": own[order].tobytes(), "dim": 16, "label": "b", "cell": cell, "ids": [], "k0": [], "k1": []}, references)
        least, most = hard_negatives.score_bounds(block["norm"], block["angles"], ring)
        s = hard_negatives.scores(block["q"], ring["q"])
        assert (s.min(axis=1) >= least).all() and (s.max(axis=1) <= most).all()
        for want in (0.5, 0.8, 0.95):
            wanted = want * block["norm"] * block["norm"]
            for i in range(len(block["q"])):
                a, b = hard_negatives.overlap(block["norm"][i:i + 1], block["angles"][i:i + 1], ring, wanted[i:i + 1])
                reach = np.flatnonzero(s[i] >= wanted[i])
                assert not len(reach) or (a <= reach.min() and reach.max() < b)
        passed += int((most < 0.8 * block["norm"] ** 2).sum())
    assert passed > 100  # many pairs of anchor and ring are passed over
