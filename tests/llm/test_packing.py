import random
import time
import zlib

import numpy as np
import pytest

from pluvio.llm import packing, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def exact():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(queries.tokenizer_paths()[0])
    t.encode_special_tokens = True
    return t


def check_packed(out, limits=(1024, 256, 1024)):
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: (r["offset"], r["length"]))
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        assert at <= limits[0]
        assert len(rows) <= limits[1]
    return by


def test_documents(spark, exact):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op10_vector_packing(spark, SF).collect()
    by = check_packed(out)
    pieces = {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
    assert pieces.keys() == docs.keys()
    for d, rows in pieces.items():
        ids = np.array([*exact.encode(docs[d], add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            assert r["start"] == at
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    used = [sum(r["length"] for r in rows) for rows in by.values()]
    padding = sum(0 if u & (u - 1) == 0 else 1024 - u for u in used)
    assert padding <= 0.02 * sum(used)


def test_both_encoders_agree_where_ranks_serve(exact):
    quick = packing.Encoder(*queries.tokenizer_paths())
    rng = random.Random(2)
    latin = [chr(c) for c in range(0x250)]
    assert not any(packing.OTHER_CHARS.search(c) for c in latin)
    texts = [f"a{c}b {c} {c}{c}\n{c}1{c}'{c}" for c in latin]
    texts += ["".join(rng.choice(latin) for _ in range(rng.randrange(200))) for _ in range(3000)]
    texts += ["<|endoftext|> x", "a" * 20_000, " " * 20_000, "\n" * 5000 + "x", "ab " * 30_000]
    for t in texts:
        assert quick(t).tolist() == exact.encode(t, add_special_tokens=False).ids, t[:80]
    for t in ("漢字 тест", "x\u2003y", "😀 a"):
        assert packing.OTHER_CHARS.search(t)
        assert quick(t).tolist() == exact.encode(t, add_special_tokens=False).ids


def test_millions_of_white_space_characters(exact):
    both = packing.Encoder(*queries.tokenizer_paths())
    for t in (" " * 3_000_000, "a" + "\t" * 1_000_000 + "b", "x\n" + "\n\xa0\x85 " * 250_000 + "y z"):
        assert both(t).tolist() == exact.encode(t, add_special_tokens=False).ids
    for at in (0, 1, 999, 1000, 1001):  # wherever a run of 10,000 begins
        assert packing.SPACES.search(("x" * at + " " * 10_000 + "y")[::packing.SPARSE])


def test_three_limits_hold_for_instruction_data(spark):
    rng = random.Random(4)
    rows = [(i, 0, n, min(n, rng.randrange(1 + n)), "x") for i in range(3000) for n in [rng.choice([1, 3, 20, 100, 300, 512])]]
    df = spark.createDataFrame(rows, "doc_id long, start long, length long, loss long, offset string")
    out = packing.pack(df, max_tokens=512, max_segments=6, max_loss=200 + 312, groups=2).collect()
    by = check_packed(out, (512, 6))
    tight = packing.pack(df.filter("loss <= 150"), max_tokens=512, max_segments=6, max_loss=150, groups=2).collect()
    for rows_ in check_packed(tight, (512, 6)).values():
        assert sum(r["loss"] for r in rows_) <= 150
    assert len(out) == len(rows)
    # no two pieces of over half a sequence share one
    lower = max(sum(r[2] for r in rows) / 512, len(rows) / 6, sum(r[2] > 256 for r in rows))
    assert len(by) <= 1.1 * lower + 4
    with pytest.raises(Exception, match="exceeds a limit"):
        packing.pack(df, max_tokens=100).collect()


def test_dot_product_choice():
    f = packing._Filler((10, 5, 10), 0)
    f.add(np.array([[4, 1, 4], [9, 1, 0], [6, 1, 6], [1, 1, 1]], dtype=float), np.arange(4))
    f.fill(0)
    # the largest product with the free limits first, then what still fits
    assert f.placed[0][:2] == (2, 0)
    assert [(r, s) for r, s, _ in f.placed] == [(2, 0), (0, 0), (1, 1), (3, 1)]


def plain_choice(demand, limits):
    """Each piece scored at every step."""
    placed, free, sequence = [], np.ones(len(demand), bool), 0
    while free.any():
        remaining, offset = np.array(limits, float), 0
        while (fits := free & (demand <= remaining).all(axis=1)).any():
            best = int(np.where(fits, demand / limits @ (remaining / limits), -1.0).argmax())
            placed.append((best, sequence, offset))
            offset += int(demand[best, 0])
            remaining -= demand[best]
            free[best] = False
            if remaining[0] < 1 or remaining[1] < 1:
                break
        sequence += 1
    return placed


@pytest.mark.parametrize("kind", ["documents", "alike", "loss", "empty"])
def test_choice_by_demand_is_the_choice_by_piece(kind):
    rng = np.random.default_rng(7)
    n = 700
    length = {"documents": np.where(rng.random(n) < 0.5, 64, rng.integers(1, 64, n)), "alike": rng.choice([0, 3, 20, 64], n),
              "loss": rng.integers(1, 40, n), "empty": np.zeros(n)}[kind]
    loss = rng.integers(0, 30, n) if kind == "loss" else length
    demand = np.stack([length, np.ones(n), loss], axis=1).astype(float)
    f = packing._Filler((64, 6, 64), 0)
    f.add(demand, np.arange(n))
    f.fill(0)
    assert f.placed == plain_choice(demand, np.array((64, 6, 64), float))


def test_work_follows_demands_not_pieces_that_wait():
    def seconds(n, rounds):
        took = []
        for _ in range(5):
            fillers = [packing._Filler((1024, 256, 1024), 0) for _ in range(rounds)]
            for f in fillers:
                f.add(np.tile([8.0, 1.0, 8.0], (n, 1)), np.arange(n))
            began = time.process_time()
            for f in fillers:
                f.fill(0)
            took.append((time.process_time() - began) / (n * rounds))
        return min(took)

    assert seconds(packing.WINDOW, 1) < 4 * seconds(64, 20)


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, "a " * 100_000, 5), (None, "b", 5), (4, "c", 5), (4, "c", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id long")
    pieces = packing.token_pieces(df, *queries.tokenizer_paths(), with_ids=True)
    out = packing.pack(pieces).collect()
    check_packed(out)
    n = {}
    for r in out:
        n[r["doc_id"]] = n.get(r["doc_id"], 0) + r["length"]
        assert len(r["ids"]) == r["length"]
    assert n[1] == n[2] == 1
    assert n[None] == 2
    assert n[4] == 4
    assert packing.pack(packing.token_pieces(df.limit(0), *queries.tokenizer_paths())).count() == 0
