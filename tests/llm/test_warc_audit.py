import random

from pluvio.llm import queries, warc_audit

SF = "/root/testdata/sf0.01"


def plain(first, second):
    """{(file, offset): status} by comparing everything."""
    a, b = {}, {}
    for side, rows in ((a, first), (b, second)):
        for _, f, o, p in rows:
            if o is not None:
                side.setdefault((f or "", o), set()).add(bytes(p or b""))
    return {k: "missing" if k not in b else "added" if k not in a else "intact" if a[k] == b[k] else "corrupt" for k in a.keys() | b.keys()}


def as_rows(df):
    return [(r["record_id"], r["file"], r["offset"], r["payload"]) for r in df.select("record_id", "file", "offset", "payload").collect()]


def test_pages(spark):
    first, second = queries._replicas(spark, SF)
    want = plain(as_rows(first), as_rows(second))
    out = queries.op8_warc_fixity_audit(spark, SF).collect()
    assert {(r["file"], r["offset"]): r["status"] for r in out} == want
    assert len(out) == len(want)
    assert {r["status"] for r in out} == {"intact", "corrupt", "missing"} | set(want.values())


def test_random_damage_in_deep_trees(spark):
    rng = random.Random(8)
    first = []
    for f in ("a", "b", "c"):
        at = 0
        for i in range(150):
            p = rng.randbytes(rng.randrange(1, 400))
            first.append((i, f, at, p))
            at += len(p)
    second = [r for r in first if rng.random() > 0.02]
    second = [(i, f, o, p[:-1] + b"?") if f != "b" and rng.random() < 0.02 else (i, f, o, p) for i, f, o, p in second]
    second += [(999, "d", 0, b"new"), (998, "a", 10**6, b"late")]
    schema = "record_id long, file string, offset long, payload binary"
    x, y = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    for size, fan in ((512, 3), (1 << 20, 16)):
        out = warc_audit.audit(x, y, size, fan).collect()
        assert {(r["file"], r["offset"]): r["status"] for r in out} == plain(first, second)
    same = warc_audit.audit(x, x, 512, 3).collect()
    assert {r["status"] for r in same} == {"intact"}
    assert all(r["other_digest"] is None for r in same)


def test_odd_rows(spark):
    schema = "record_id long, file string, offset long, payload binary, status string"
    first = [(1, None, 0, None, "x"), (2, "f", None, b"a", "x"), (3, "f", 0, b"", "x"), (4, "f", 0, b"", "x"), (5, "f", 9, b"z" * 500_000, "x"),
             (None, "g", 0, b"q", "x")]
    second = [(1, None, 0, b"", "x"), (2, "f", None, b"a", "x"), (3, "f", 0, b"!", "x"), (5, "f", 9, b"z" * 500_000, "x"), (None, "g", 0, b"q", "x")]
    x, y = spark.createDataFrame(first, schema), spark.createDataFrame(second, schema)
    out = sorted(((r["record_id"] or 0, r["file"], r["status"]) for r in warc_audit.audit(x, y).collect()))
    assert out == [(0, "g", "intact"), (1, "", "intact"), (2, "f", "unplaced"), (2, "f", "unplaced"), (3, "f", "corrupt"), (4, "f", "corrupt"),
                   (5, "f", "intact")]
    assert warc_audit.audit(x.limit(0), y.limit(0)).count() == 0
    assert {r["status"] for r in warc_audit.audit(x, y.limit(0)).collect()} == {"missing", "unplaced"}
    assert {r["status"] for r in warc_audit.audit(x.limit(0), y).collect()} == {"added", "unplaced"}


def test_copies_are_one_child(spark):
    schema = "record_id long, file string, offset long, payload binary"
    first = [(1, "f", 0, b"")] * 3000 + [(2, "f", 0, b"a"), (3, "f", 1, b"b")]
    x = spark.createDataFrame(first, schema)
    got = {(r["offset"], r["length"]): r["n"] for r in warc_audit.children(warc_audit.leaves(x)).collect()}
    assert got == {(0, 0): 3000, (0, 1): 1, (1, 1): 1}
    roots = [warc_audit.tree(warc_audit.leaves(spark.createDataFrame(r, schema)), 0)[0].collect() for r in (first, first[1:], first[::-1])]
    assert roots[0] != roots[1]
    assert roots[0] == roots[2]
    for second in (first, first[5:], first[:-2], [*first, (4, "f", 1, b"c")]):
        out = warc_audit.audit(x, spark.createDataFrame(second, schema)).collect()
        assert len(out) == len(first)
        assert {(r["file"], r["offset"]): r["status"] for r in out} == plain(first, second)
