import zlib

import numpy as np
from pyspark.sql import functions as F

from pluvio.llm import queries, sharding

SF = "/root/testdata/sf0.01"


def test_permutation_is_a_bijection_with_inverse():
    for n in (1, 2, 3, 7, 8, 9, 100, 1000, 4097):
        x = np.arange(n)
        p = sharding.permute(x, n, 5)
        assert sorted(p) == list(range(n))
        assert (sharding.unpermute(p, n, 5) == x).all()
    n = 10**15 + 3
    x = np.array([0, 1, 2, n - 1, n // 2])
    assert (sharding.unpermute(sharding.permute(x, n, 9), n, 9) == x).all()
    assert (sharding.permute(np.arange(1000), 1000, 1) != sharding.permute(np.arange(1000), 1000, 2)).any()


def test_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.op5_sharding(spark, SF).collect()
    number = {d: i for i, d in enumerate(sorted(docs))}
    slots = {}
    for r in out:
        text = (docs[r["doc_id"]] or "").encode()
        assert r["size"] == len(text) + 1
        assert r["text_crc32"] == zlib.crc32(text)
        at = int(sharding.permute(np.array([number[r["doc_id"]]]), len(docs), 0)[0])
        assert (r["shard"], r["slot"]) == (at % 8, at // 8)
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["law"] == "rows"
        assert r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_same_for_any_partitioning_and_odd_rows(spark, tmp_path):
    rows = [(i, f"t{i}", 1) for i in range(100)] + [(None, None, 2), (None, "", 3), (5, "t5", 1), (5, "t5", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text").asc_nulls_last()]
    one = sharding.assign_shards(df, 3, order, seed=4)
    two = sharding.assign_shards(df.repartition(7), 3, order, seed=4)
    as_rows = lambda d: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "", r["shard"], r["slot"]) for r in d.collect())
    assert as_rows(one) == as_rows(two)
    assert len(as_rows(one)) == len(rows)
    assert one.columns == ["doc_id", "text", "shard", "slot"]
    assert sharding.assign_shards(df.limit(0), 3, order).count() == 0
    sharding.write_shards(one, str(tmp_path / "out"), rows_per_file=10)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert as_rows(back) == as_rows(one)
