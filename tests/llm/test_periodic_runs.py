import hashlib
import random
import zlib

import numpy as np

from pluvio.llm import periodic_runs, queries

SF = "/root/testdata/sf0.001"


def brute(words, least=6):
    """(start, length, period) of all runs, by trying every period at every place."""
    n, out = len(words), set()
    code = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([code[w] for w in words], np.int64)
    for q in range(1, n // 4 + 1):
        edge = np.diff(np.concatenate([[0], (x[q:] == x[:-q]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            a, length = int(a), int(b - a) + q
            part = x[a:a + length]
            if length >= max(least, 4 * q) and not any((part[p:] == part[:-p]).all() for p in range(1, q)):
                out.add((a, length, q))
    return sorted(out)


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def made(seed, count=60):
    rng = random.Random(seed)
    out = [["a"] * 5, ["a"] * 6, ["a"] * 4 + ["b"] * 300, "a b".split() * 64, []]
    a, b = ["x"], ["x", "y"]  # a word full of repetitions
    for _ in range(11):
        a, b = b, b + a
    out.append(b)
    for _ in range(count):
        words = []
        for _ in range(rng.randint(1, 6)):
            unit = [rng.choice("abc") for _ in range(rng.choice([1, 2, 3, 5, 8, 13, 16, 17, 31, 32, 33, 64]))]
            words += (unit * 12)[:rng.randint(1, 7 * len(unit))]
            words += [rng.choice("abcdefg") for _ in range(rng.randint(0, 9))]
        out.append(words)
    nested = (["p"] * 9 + ["q"]) * 6
    return [*out, (nested + ["r"]) * 5, [rng.choice("ab") for _ in range(700)]]


def test_runs_of_texts_together():
    texts = made(1)
    start = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    code = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    got = periodic_runs.find(np.array([code[w] for t in texts for w in t]), start)
    assert len(got) == len(set(got))
    for t, s in zip(texts, start.tolist(), strict=False):
        own = sorted((a - s, length, q) for a, length, q in got if s <= a < s + len(t))
        assert own == brute(t, 4), t[:20]


def test_collapse(spark):
    texts = made(2)
    docs = spark.createDataFrame([(i, " \n".join(t), "x") for i, t in enumerate(texts)], "doc_id long, text string, runs string").repartition(3)
    got = {r["doc_id"]: r for r in periodic_runs.collapse_runs(docs).collect()}
    for i, t in enumerate(texts):
        runs = brute(t)
        assert [tuple(r) for r in got[i]["runs"]] == runs
        assert got[i]["collapsed"] == collapsed(t, runs)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \t\n"), (None, "z " * 7), (None, "z " * 7), (5, "é é " * 6)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0, [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.collapse_runs(docs).collect()), key=str)
    assert got == sorted([(1, [], ""), (2, [], ""), (3, [], ""), (0, [(0, 7, 1)], "z"), (0, [(0, 7, 1)], "z"), (5, [(0, 6, 1)], "é é")], key=str)
    assert periodic_runs.collapse_runs(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    rng = random.Random(4)
    unit = [f"w{rng.randint(0, 500)}" for _ in range(20_000)]
    words = ["start"] + unit * 5 + ["end"]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    got = [tuple(x) for x in periodic_runs.collapse_runs(docs).first()["runs"]]
    assert (1, 100_000, 20_000) in got


def tailed(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return [w.decode() for w in words]


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = tailed(d["doc_id"], d["text"])
        runs = brute(words)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        some += bool(runs)
        r = got[d["doc_id"]]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert some > 5
