"""Join helpers: size-checked broadcast, key-renaming left joins, full joins with
a coalesced key, and scalar (one-value) subqueries in place of cross joins."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# broadcast only below these sizes (proven bounds, checked at run time)
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
FIXED_WIDTH = {"boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz"}


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Return ``broadcast(df)`` when ``df`` is proven to hold at most ``max_rows``
    rows and ``max_bytes`` (8 bytes a value, and the length of each text), else ``df``
    unchanged: the join then shuffles both sides and AQE may still convert it or split
    skewed partitions. Use it on small, cheap sides (maps)."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema
             if f.dataType.typeName() not in FIXED_WIDTH]
    size = F.lit(8 * len(df.columns)).cast("bigint")
    for t in texts:
        size = size + t
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if r[0] <= max_rows and r[1] <= max_bytes else df


def scalar(df: DataFrame, expr: Column) -> Column:
    """A one-value aggregate of ``df`` usable as a column anywhere (scalar subquery):
    computed once, never a cross join."""
    return df.select(expr.alias("v")).scalar()


def left_join_as(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Left join where keys are named differently (``{left_key: right_key}``); the
    right keys are dropped, the left names kept."""
    r = right.withColumnsRenamed({rk: f"_rk_{rk}" for rk in pairs.values()})
    cond = [left[lk] == r[f"_rk_{rk}"] for lk, rk in pairs.items()]
    return left.join(r, cond, "left").drop(*[f"_rk_{rk}" for rk in pairs.values()])


def full_join_on(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with each key coalesced into one column (join by name)."""
    return left.join(right, on=keys, how="full")
