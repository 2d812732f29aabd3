"""Merkle fixity audit of WARC replicas.

Every record is hashed; records of a file are leaves under offset ranges of fixed
length, and ranges are grouped ``fan`` at a time up to one root a file. Replicas are
compared root first, and only branches that differ are entered, level by level, down
to the records of the ranges that differ. Tree nodes are keyed by file and range, so a
file with most of the records spreads over as many tasks as it has ranges.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import store

RANGE = 1 << 18   # bytes of offsets under one lowest node
FAN = 16          # children of a node


def record_bytes(record_id: Column, url: Column, body: Column) -> Column:
    """A WARC response record: header block, body and the closing empty lines. Null
    parts count as empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "UTF-8")


def leaves(records: DataFrame) -> DataFrame:
    """record_id, file, offset, length and digest of records (record_id, file, offset,
    payload); stored. A null payload counts as an empty record."""
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit("").cast("binary"))
    return store(records.select(F.col("record_id").cast("long"), F.coalesce(F.col("file").cast("string"), F.lit("")).alias("file"),
                                F.col("offset").cast("long"), F.octet_length(payload).cast("long").alias("length"),
                                F.sha2(payload, 256).alias("digest")))


def _node(children: str) -> Column:
    """Digest over the children in order; ``children`` names the ordered fields."""
    fields = [c.strip() for c in children.split(",")]
    each = F.transform(F.array_sort(F.collect_list(F.struct(*fields))),
                       lambda s: F.concat_ws(":", *[s[f].cast("string") for f in fields]))
    return F.sha2(F.array_join(each, "\n"), 256)


def children(leaf: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """(file, node, offset, length, digest, n): the placed records of ``leaf`` under their
    ranges, rows alike in all of these counted by ``n``."""
    return (leaf.filter(F.col("offset").isNotNull())
            .groupBy("file", F.expr(f"offset div {range_bytes}L").alias("node"), "offset", "length", "digest")
            .agg(F.count(F.lit(1)).alias("n")))


def tree(leaf: DataFrame, depth: int, range_bytes: int = RANGE, fan: int = FAN) -> list[DataFrame]:
    """Levels from the lowest ranges to the roots: (file, node, digest). A node's group
    is at most the different records that begin in a range, or ``fan`` children."""
    levels = [store(children(leaf, range_bytes).groupBy("file", "node")
                    .agg(_node("offset, length, digest, n").alias("digest")))]
    for _ in range(depth):
        levels.append(store(levels[-1].groupBy("file", F.expr(f"node div {fan}L").alias("up"))
                            .agg(_node("node, digest").alias("digest")).withColumnRenamed("up", "node")))
    return levels


def _depth(leaf_a: DataFrame, leaf_b: DataFrame, range_bytes: int, fan: int) -> int:
    last = leaf_a.select("offset").union(leaf_b.select("offset")).agg(F.max("offset")).first()[0] or 0
    nodes, depth = last // range_bytes + 1, 0
    while nodes > 1:
        nodes, depth = -(-nodes // fan), depth + 1
    return depth


def audit(first: DataFrame, second: DataFrame, range_bytes: int = RANGE, fan: int = FAN) -> DataFrame:
    """``audit_leaves`` of two replicas (record_id, file, offset, payload): payloads are
    hashed where they are read and travel no further."""
    return audit_leaves(leaves(first), leaves(second), range_bytes, fan)


def audit_leaves(a: DataFrame, b: DataFrame, range_bytes: int = RANGE, fan: int = FAN) -> DataFrame:
    """One row for each record of either replica (both stored: record_id, file, offset,
    length, digest): record_id, file, offset, length and digest (of the first replica, or of
    the second where only it has the record), other_digest, and status: intact, corrupt
    (bytes differ), missing (not in the second), added (not in the first), or unplaced
    (null offset). A record is known by file and offset; where several rows of a replica
    share these (repeated rows), they are compared as a sorted set and their rows get
    the status of the set. other_digest is null for records under nodes that agree: they
    weren't looked at one by one."""
    depth = _depth(a, b, range_bytes, fan)
    ta, tb = tree(a, depth, range_bytes, fan), tree(b, depth, range_bytes, fan)
    differing = None
    for level in range(depth, -1, -1):
        x, y = ta[level], tb[level]
        if differing is not None:
            up = differing.select(F.col("file").alias("_f"), F.col("node").alias("_up"))
            below = lambda t: t.join(up, (F.col("file") == F.col("_f")) & (F.expr(f"node div {fan}L") == F.col("_up")), "left_semi")  # noqa: E731,B023
            x, y = below(x), below(y)
        y = y.withColumnsRenamed({"file": "file_b", "node": "node_b", "digest": "digest_b"})
        differing = store(x.join(y, (F.col("file") == F.col("file_b")) & (F.col("node") == F.col("node_b")), "full")
                          .filter(~F.col("digest").eqNullSafe(F.col("digest_b")))
                          .select(F.coalesce("file", "file_b").alias("file"), F.coalesce("node", "node_b").alias("node")))
    at = differing.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    inside = (F.col("file") == F.col("_f")) & (F.expr(f"offset div {range_bytes}L") == F.col("_n"))

    def sets(leaf, side):
        return (leaf.join(at, inside, "left_semi").groupBy(F.col("file").alias(f"{side}f"), F.col("offset").alias(f"{side}o"))
                .agg(F.array_join(F.array_sort(F.collect_set("digest")), ",").alias(f"{side}d")))
    met = sets(a, "a").join(sets(b, "b"), (F.col("af") == F.col("bf")) & (F.col("ao") == F.col("bo")), "full")
    told = store(met.select(
        F.coalesce("af", "bf").alias("_f"), F.coalesce("ao", "bo").alias("_o"), F.col("bd").alias("other_digest"),
        F.when(F.col("bd").isNull(), "missing").when(F.col("ad").isNull(), "added")
        .when(F.col("ad") == F.col("bd"), "intact").otherwise("corrupt").alias("status")))
    here = (F.col("file") == F.col("_f")) & (F.col("offset") == F.col("_o"))
    own = a.join(told.filter("status <> 'added'"), here, "left").withColumn(
        "status", F.when(F.col("offset").isNull(), "unplaced").otherwise(F.coalesce("status", F.lit("intact"))))
    only_b = (b.join(told.filter("status = 'added'"), here)
              .unionByName(b.filter(F.col("offset").isNull()).withColumn("status", F.lit("unplaced")), allowMissingColumns=True))
    cols = ["record_id", "file", "offset", "length", "digest", "other_digest", "status"]
    return own.select(*cols).union(only_b.select(*cols))
