import numpy as np
import pytest
import reference as ref

from pluvio.llm import vector_dedup

SF = "/root/testdata/sf0.01"


def brute(rows, threshold=0.93):
    """{vec_id: (n_links, component)}"""
    good = [(i, label, np.array(v, dtype=np.float64)) for i, v, label in rows
            if label is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v))]
    links, n = [], {i: 0 for i, _, _ in rows}
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a], good[b]
            if x[1] == y[1] and len(x[2]) == len(y[2]) and x[2] @ y[2] / np.sqrt((x[2] @ x[2]) * (y[2] @ y[2])) >= threshold:
                links.append((x[0], y[0]))
                n[x[0]] += 1
                n[y[0]] += 1
    comp = ref.components(n, links)
    return {i: (n[i], comp[i]) for i in n}


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in df.collect()}


def test_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert got(vector_dedup.near_vectors(df)) == brute([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])


def test_clusters_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((4, 16))
    rows = []
    for i in range(600):
        v = centre[i % 4 if i % 3 else 0] + rng.standard_normal(16) * (0.1 + 0.25 * (i % 5 == 0))
        rows.append((i, [float(x) for x in v], i % 2))
    rows += [(1000 + i, rows[0][1], 0) for i in range(50)]
    monkeypatch.setattr(vector_dedup, "BLOCK", 64)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(vector_dedup.near_vectors(df)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, -0.0], 1), (11, [1.0, 0.0, 0.0], 1),
            (12, [1.0, 0.0], 2), (13, [1e-300, 0.0], 1), (14, [1e300, 1e299], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, kept string")
    out = got(vector_dedup.near_vectors(df))
    assert out == {i: (0, i) for i in (1, 2, 3, 4, 5, 6, 7, 11, 12)} | {i: (4, 8) for i in (8, 9, 10, 13, 14)}
    nulls = spark.createDataFrame([(None, [1.0], 1), (3, [1.0], 1), (3, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.near_vectors(nulls).collect()), key=str) == sorted(
        [(None, 0, None, True), (3, 1, 3, True), (3, 1, 3, True)], key=str)
    assert vector_dedup.near_vectors(df.limit(0)).count() == 0


def test_ids_shared_by_different_vectors(spark):
    rows = [(1, [1.0, 0.0], "L1"), (1, [0.0, 1.0], "L1"), (2, [1.0, 0.01], "L1"), (2, [0.0, 1.0], "L2"), (3, [1.0, 0.0], "L2")]
    out = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect()) == [(1, 0, 1), (1, 1, 1), (2, 0, 2), (2, 1, 1), (3, 0, 3)]


def test_pairs_at_the_threshold_are_settled_in_doubles(spark):
    """Cosines closer to the threshold than the steps can tell."""
    rows = []
    for i in range(40):
        cos = 0.93 + (i - 20) * 1e-7
        rows += [(3 * i, [1.0, 0.0, 0.0], i), (3 * i + 1, [cos, float(np.sqrt(1 - cos * cos)), 0.0], i)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(vector_dedup.near_vectors(df)) == brute(rows)


@pytest.mark.parametrize("classes", [1, 1000, 10**6, 10**9])
def test_tables_keep_the_miss_bound(classes):
    bits, tables = vector_dedup.bits_and_tables(classes, 0.93)
    agree = (1 - np.arccos(0.93) / np.pi) ** bits
    assert (1 - agree) ** tables <= vector_dedup.MISS
