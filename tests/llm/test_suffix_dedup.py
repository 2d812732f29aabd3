import hashlib
import random

import numpy as np
import pytest

from pluvio.llm import queries, suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(texts, length):
    """Per text (in order): the removed byte runs and what stays."""
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - length + 1):
            seen.setdefault(b[i:i + length], []).append((d, i))
    gone = [np.zeros(len(b), bool) for b in raw]
    for at in seen.values():
        if len(at) > 1:
            for d, i in at:
                gone[d][i:i + length] = True
    out = []
    for b, g in zip(raw, gone, strict=True):
        edge = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
        out.append((runs, bytes(np.frombuffer(b, np.uint8)[~g])))
    return out


def check(spark, texts, length):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string").repartition(3)
    got = {r["doc_id"]: r for r in suffix_dedup.repeated_spans(docs, length).collect()}
    assert len(got) == len(texts)
    for i, (runs, kept) in enumerate(brute(texts, length)):
        r = got[i]
        assert [(s["start"], s["end"]) for s in r["spans"]] == runs, (i, texts[i][:80])
        assert (bytes(r["kept"]) if r["kept"] is not None else (texts[i] or "").encode()) == kept


def passages(seed, n=60):
    """Texts that share passages, with near copies and inner repeats."""
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abcdé \n") for _ in range(rng.randint(20, 160))) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 90)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 40)))]
        out.append("".join(parts))
    out += out[:5] + [out[0] + "!", out[1][3:], "ab" * 100, "a" * 70, None, "", "short", "\0" * 50 + "a", "\0" * 49]
    return out


def test_passages(spark):
    check(spark, passages(1), 30)


def test_hot_anchor_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    rng = random.Random(3)
    common = "".join(rng.choice("abcd") for _ in range(45))
    texts = ["".join(rng.choice("wxyz") for _ in range(rng.randint(20, 60))) + common
             + "".join(rng.choice("wx") for _ in range(rng.randint(2, 60))) for _ in range(300)]
    check(spark, texts, 40)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d["doc_id"]: x for d, x in zip(docs, brute([d["text"] for d in docs], 400), strict=True)}
    got = queries.op13_suffix_dedup(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        runs, kept = want[r["doc_id"]]
        assert (r["n_removed"], r["n_spans"], r["kept_sha256"]) == (sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept).hexdigest())


def test_odd_rows(spark):
    assert suffix_dedup.repeated_spans(spark.createDataFrame([], "doc_id long, text string"), 10).count() == 0
    t = "0123456789abcdef"
    docs = spark.createDataFrame([(1, t), (1, t), (None, t), (None, None), (5, "x" + t[:9])], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1, len(r["spans"]), r["kept"]) for r in suffix_dedup.repeated_spans(docs, 10).collect()), key=str)
    assert got == sorted([(1, 1, b""), (1, 1, b""), (-1, 1, b""), (-1, 0, None), (5, 0, None)], key=str)


def test_drop_repeats(spark):
    docs = spark.createDataFrame([(1, "aé" * 10 + "tail", "l"), (2, "aé" * 10, "m"), (3, None, "n"), (4, "unlike", "o")],
                                 "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["text"], r["lang"]) for r in suffix_dedup.drop_repeats(docs, 6).collect()}
    assert got == {1: ("tail", "l"), 2: ("", "m"), 3: (None, "n"), 4: ("unlike", "o")}


@pytest.mark.parametrize("alphabet", [1, 2, 5])
def test_suffix_array_and_common_prefixes(alphabet):
    rng = np.random.default_rng(alphabet)
    segments = [bytes(rng.integers(0, alphabet, rng.integers(1, 60), dtype=np.uint8)) for _ in range(25)]
    segments += segments[:3]
    start = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
    data = np.frombuffer(b"".join(segments), np.uint8)
    # end marks sort below bytes, by segment
    of = {int(start[s]) + o: tuple([c + 1000 for c in seg[o:]] + [s]) for s, seg in enumerate(segments) for o in range(len(seg))}
    sa, rank = suffix_dedup.suffix_array(data, start)
    assert sa.tolist() == sorted(of, key=of.get) and (sa[rank] == np.arange(len(data))).all()
    got = suffix_dedup.common_prefixes(data, start, sa, rank, np.diff(start))
    for a, b in zip(sa, sa[1:], strict=False):
        x, y = of[int(a)][:-1], of[int(b)][:-1]
        same = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        assert got[b] == same


def test_merged_slices():
    rng = np.random.default_rng(1)
    slices = [(np.sort(rng.integers(0, 40, 12).astype(np.uint64)), rng.integers(0, 2, 12).astype(np.uint64)) for _ in range(5)]
    slices = [tuple(np.array(x) for x in zip(*sorted(set(zip(a.tolist(), b.tolist(), strict=True))), strict=True)) for a, b in slices]
    slices = [(a.astype(np.uint64), b.astype(np.uint64)) for a, b in slices]
    every = [(int(a), int(b)) for f0, f1 in slices for a, b in zip(f0, f1, strict=True)]
    want = {(s, i) for s, (f0, f1) in enumerate(slices) for i, (a, b) in enumerate(zip(f0, f1, strict=True)) if every.count((int(a), int(b))) > 1}
    assert set(suffix_dedup.merged_slices(slices)) == want
