"""Projection, rename and schema operators. These act on the schema (column
names), which is driver-side metadata; no data moves through the driver."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def q(name: str):
    """Column by exact name (names may hold dots or spaces)."""
    return F.col(f"`{name}`")


def select_first(df: DataFrame, *first: str) -> DataFrame:
    """Named columns first, then every other column in its current order."""
    rest = [c for c in df.columns if c not in first]
    return df.select(*[q(c) for c in (*first, *rest)])


def with_prefix(df: DataFrame, prefix: str, ignore_case: bool = True) -> list[str]:
    p = prefix.lower() if ignore_case else prefix
    return [c for c in df.columns if (c.lower() if ignore_case else c).startswith(p)]


def containing(df: DataFrame, text: str, ignore_case: bool = True) -> list[str]:
    t = text.lower() if ignore_case else text
    return [c for c in df.columns if t in (c.lower() if ignore_case else c)]


def select_prefix(df: DataFrame, *prefixes: str, drop: bool = False) -> DataFrame:
    """Keep (or with ``drop`` remove) the columns starting with any prefix
    (case-insensitive, like the usual column-selection helpers)."""
    hit = {c for p in prefixes for c in with_prefix(df, p)}
    keep = [c for c in df.columns if (c in hit) != drop]
    return df.select(*[q(c) for c in keep])


def keep_existing(df: DataFrame, wanted) -> DataFrame:
    """Select the wanted columns that exist, in the wanted order."""
    return df.select(*[q(c) for c in wanted if c in df.columns])


def add_missing(df: DataFrame, cols, dtype: str = "string") -> DataFrame:
    """Add each absent column as a typed null."""
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast(dtype) for c in missing}) if missing else df


def columns_of_type(df: DataFrame, kind) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def drop_strings(df: DataFrame, keep=()) -> DataFrame:
    """Drop the text columns (except ``keep``)."""
    return df.drop(*[c for c in columns_of_type(df, T.StringType) if c not in keep])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename old -> new; absent old names and blank new names are ignored. Two columns of
    one name (in any case, as tables are written) are refused."""
    m = {o: n for o, n in mapping.items() if o and n and o in df.columns}
    sources: dict[str, list[str]] = {}
    for c in df.columns:
        sources.setdefault(m.get(c, c).lower(), []).append(c)
    clash = {new: old for new, old in sources.items() if len(old) > 1 and any(c in m for c in old)}
    if clash:
        raise ValueError("columns would share a name: " + "; ".join(f"{new}: {', '.join(old)}" for new, old in clash.items()))
    return df.select(*[q(c).alias(m.get(c, c)) for c in df.columns]) if m else df


def rename_by_table(df: DataFrame, rename_map: DataFrame, dataset: str | None = None,
                    old: str = "old_name", new: str = "new_name",
                    dataset_col: str = "dataset") -> DataFrame:
    """Rename from a mapping table (old, new[, dataset]). Rows with a blank old or
    new name are dropped. Only the rows whose old name is a column of ``df`` are read,
    so what reaches the driver is bounded by the schema, whatever the map's length; a
    name mapped twice takes the smaller new name, and a new name that another column has
    already is refused."""
    m = rename_map.filter(F.col(old).isNotNull() & F.col(new).isNotNull()
                          & (F.trim(F.col(old)) != "") & (F.trim(F.col(new)) != ""))
    if dataset is not None:
        m = m.filter(F.col(dataset_col) == dataset)
    own = m.filter(F.col(old).isin(df.columns)).groupBy(old).agg(F.min(new))
    pairs = {r[0]: r[1] for r in own.collect()}
    return rename(df, pairs)


def rename_regex(df: DataFrame, rules) -> DataFrame:
    """Rewrite every column name with ordered (pattern, replacement) rules, then trim."""
    names = []
    for c in df.columns:
        n = c
        for pat, rep in rules:
            n = re.sub(pat, rep, n)
        names.append(n.strip())
    return df.toDF(*names)
