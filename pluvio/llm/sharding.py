"""Reproducible shuffle into shards by a keyed permutation of global row numbers.

Rows get a global number from their order alone (identifier, then the row's digest
columns), a Feistel network over [0, n) sends number to position, and position p is
slot p // k of shard p % k. Shard sizes differ by one row at most; where a row lies,
and which row lies in a slot, follow from (number, n, k, seed) without any table.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import fresh, partitions, store, without

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser: the round function before reduction."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    out = _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), seed & (2**64 - 1))
    return [int(k) for k in out]


def _walk(x: np.ndarray, n: int, step) -> np.ndarray:
    """Cycle walking: positions past n go round again; as ``step`` is a bijection of
    a domain that holds [0, n), every walk comes back into it."""
    x = step(np.asarray(x, dtype=np.int64))
    out = x >= n
    while out.any():
        x[out] = step(x[out])
        out = x >= n
    return x


def permute(x: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Position of each number of [0, n)."""
    side = max(1, math.isqrt(max(n - 1, 0)) + 1)

    def step(v):
        left, right = v // side, v % side
        for k in _keys(seed):
            left, right = right, (left + (_mix(right, k) % np.uint64(side)).astype(np.int64)) % side
        return left * side + right
    return _walk(x, n, step)


def unpermute(p: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The number at each position of [0, n)."""
    side = max(1, math.isqrt(max(n - 1, 0)) + 1)

    def step(v):
        left, right = v // side, v % side
        for k in reversed(_keys(seed)):
            left, right = (right - (_mix(left, k) % np.uint64(side)).astype(np.int64)) % side, left
        return left * side + right
    return _walk(p, n, step)


def numbered(df: DataFrame, order: list, out: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with a global row number from 0 in ``order`` (columns that tell rows
    apart; rows alike in all of them may swap), and the number of rows. Numbers don't
    depend on the partitioning: they are the rank in a total order."""
    mid, pid = fresh(df, "mid", "pid")
    n = partitions(df.sparkSession)
    rows = store(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn(mid, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(mid), 33)
    counts = rows.groupBy(part.alias(pid)).agg(F.count(F.lit(1)).alias("_n"))
    # one row for each partition of the sort
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(pid, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    total = rows.count()
    got = (rows.withColumn(pid, part).join(F.broadcast(offsets), pid)
           .withColumn(out, F.col("_before") + F.col(mid).bitwiseAND(2**33 - 1)).drop(pid, mid, "_before"))
    return got, total


def assign_shards(df: DataFrame, shards: int, order: list, seed: int = 0) -> DataFrame:
    """``df`` plus shard (int) and slot (long): shard sizes differ by at most one,
    slots of a shard run from 0 without a gap. Nulls in ``order`` stand where its columns
    put them; rows alike in all of ``order`` get numbers of their own, whichever gets
    which. Extra columns of these names are replaced. An empty table gives an empty
    result."""
    if shards < 1:
        raise ValueError("shards must be positive")
    df = without(df, "shard", "slot")
    num, pos = fresh(df, "num", "pos")
    rows, n = numbered(df, order, num)

    @F.pandas_udf("long")
    def position(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed))

    return (rows.withColumn(pos, position(num))
            .withColumns({"shard": (F.col(pos) % shards).cast("int"),
                          "slot": F.expr(f"`{pos}` div {shards}L")})
            .drop(num, pos))


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet folders shard=k, each file a range of slots in slot order."""
    part = F.expr(f"slot div {int(rows_per_file)}L")
    (sharded.withColumn("_file", part).repartition("shard", "_file").drop("_file")
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
