import reference as ref
from pyspark.sql import functions as F

import corpus_pipeline
from pluvio.llm import mixing

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.store(stage(spark, docs, SF))
        assert out.columns == columns
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        after = sorted(r["doc_id"] for r in out.collect())
        if name == "language ID":  # prose is kept
            assert {d for d, t in before.items() if len(ref.WORD.findall(t)) > 5} <= set(after)
        if name == "exact dedup":
            assert after == sorted(d for d, w in ref.exact_groups(before.items()).items() if w[2])
        if name == "MinHash near-dedup":
            assert after == sorted(d for d, w in ref.near_duplicates(before.items(), 5, 80).items() if w[1] == d)
        if name == "mixing sources":
            assert max(after.count(d) for d in set(after)) <= 2
            # a source misses its target by less than one of its documents
            n = mixing.word_count(F.col("text"))
            had = {r["source"]: r for r in docs.groupBy("source").agg(F.sum(n).alias("n"), F.max(n).alias("top")).collect()}
            got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(n).alias("n")).collect()}
            targets = mixing.capped_targets({s: r["n"] for s, r in had.items()}, mixing.cyclic_weights(list(had)),
                                            1.5 * sum(r["n"] for r in had.values()), 2)
            for s, t in targets.items():
                assert abs(t - got.get(s, 0)) <= had[s]["top"]
        kept[name] = after
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in packed} == set(kept["mixing sources"])
    assert sum(r["start"] == 0 for r in packed) == len(kept["mixing sources"])


def test_odd_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "the house is on the hill", "en", "s", 24), (3, "the house is on the hill", "en", "s", 24),
            (4, "the house is on the hill", "en", None, 24), (5, "123", "en", "s", 3), (None, "a hill with a house on it", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        d = table
        for _, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.store(stage(spark, d, "unused"))
        assert (d.count() > 0) == (table is docs)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
