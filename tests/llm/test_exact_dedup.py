import reference as ref

from pluvio.llm import exact_dedup

SF = "/root/testdata/sf0.01"


def got(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()}


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = ref.exact_groups([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert got(exact_dedup.exact_groups(docs)) == want
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, w in want.items() if w[2]}


def test_group_over_many_partitions(spark):
    rows = [(i, "same  text" if i % 3 else "same text") for i in range(5000, 0, -1)] + [(i, f"t{i}") for i in range(6000, 6300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = exact_dedup.exact_groups(df, keep_text=False)
    assert got(out) == ref.exact_groups(rows)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_odd_rows(spark):
    long = "w " * 200_000
    rows = [(1, None, 1), (2, "", 2), (3, " ", 3), (4, "\t \n", 4), (5, " a", 5), (6, "\x0b a", 6), (7, "a", 7),
            (8, "a\u00a0", 8), (9, long, 9), (10, long + " ", 10), (11, "A", 11), (12, " " * 100 + "q", 12), (13, " q", 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept long")
    assert got(exact_dedup.exact_groups(df)) == ref.exact_groups([r[:2] for r in rows])
    twice = spark.createDataFrame([(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y")], "doc_id long, text string")
    out = sorted((r["doc_id"] or 0, r["text"], r["keep_id"] or 0, r["group_size"], r["kept"])
                 for r in exact_dedup.exact_groups(twice).collect())
    assert out == [(0, "x", 1, 3, False), (0, "y", 0, 2, False), (0, "y", 0, 2, True), (1, "x", 1, 3, False), (1, "x", 1, 3, True)]
    assert exact_dedup.drop_exact_copies(twice).count() == 2
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    assert exact_dedup.drop_exact_copies(df.limit(0)).count() == 0


def test_rows_alike_in_id_and_text(spark):
    """Most rows are one row, or have null ids: cut over partitions, counted whole."""
    rows = [(7, "same  text")] * 3000 + [(None, "same text")] * 500 + [(9, "other")] * 2 + [(None, "x")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    out = exact_dedup.exact_groups(docs).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        by.setdefault(r["text_sha256"], []).append(r)
    assert sorted((rs[0]["keep_id"], rs[0]["group_size"], len(rs), sum(r["kept"] for r in rs)) if rs[0]["keep_id"] else (0, rs[0]["group_size"], len(rs), sum(r["kept"] for r in rs))
                  for rs in by.values()) == [(0, 3, 3, 1), (7, 3500, 3500, 1), (9, 2, 2, 1)]
    assert sorted((r["doc_id"] or 0) for r in exact_dedup.drop_exact_copies(docs).collect()) == [0, 7, 9]
