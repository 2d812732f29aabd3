"""Long <-> wide. Pivot value lists are explicit (or read once from the data and
bounded), so no hidden distinct job runs and the schema is known."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PIVOT_VALUES = 1_000


def can_pivot(df: DataFrame, col: str, limit: int | None = None) -> bool:
    """Whether a column has few enough values to be spread over columns."""
    limit = MAX_PIVOT_VALUES if limit is None else limit
    return df.select(col).distinct().limit(limit + 1).count() <= limit


def pivot_values(df: DataFrame, col: str, limit: int = MAX_PIVOT_VALUES) -> list:
    """Distinct values of a pivot column (sorted). These become column names, so
    their number is bounded; more than ``limit`` is an error, not a wide table."""
    vals = [r[0] for r in df.select(col).distinct().limit(limit + 1).collect()]
    if len(vals) > limit:
        raise ValueError(f"{col}: more than {limit} distinct values to pivot")
    return sorted(v for v in vals if v is not None)


def pivot(df: DataFrame, keys, names_from: str, values: list, aggs: dict[str, Column],
          sep: str = "_", measure_first: bool = True) -> DataFrame:
    """Group by ``keys`` and spread ``aggs`` over the ``values`` of ``names_from``.
    Output names are ``<measure><sep><value>`` (``measure_first``) or
    ``<value><sep><measure>``; a single aggregate named '' gives ``<value>``. Without
    values only the keys are left."""
    if not values:
        return df.select(*keys).distinct()
    named = [a.alias(n or "v") for n, a in aggs.items()]
    p = df.groupBy(*keys).pivot(names_from, values).agg(*named)
    ren = {}
    single = len(aggs) == 1
    for v in values:
        for n in aggs:
            spark_name = str(v) if single else f"{v}_{n or 'v'}"
            if n == "":
                new = str(v)
            else:
                new = f"{n}{sep}{v}" if measure_first else f"{v}{sep}{n}"
            ren[spark_name] = new
    return p.withColumnsRenamed(ren)


def pivot_prefixed(df: DataFrame, keys, names_from: str, values: list, value: str,
                   prefix: str, agg=F.first) -> DataFrame:
    """One measure spread into ``<prefix><value>`` columns."""
    p = df.groupBy(*keys).pivot(names_from, values).agg(agg(value))
    return p.withColumnsRenamed({str(v): f"{prefix}{v}" for v in values})


def unpivot(df: DataFrame, ids, names_to: str, values_to: str, cols=None,
            drop_nulls: bool = False, strip_prefix: str | None = None) -> DataFrame:
    """Wide -> long over ``cols`` (default: all but ``ids``); null cells are kept
    unless ``drop_nulls``."""
    ids = list(ids)
    cols = [c for c in df.columns if c not in ids] if cols is None else list(cols)
    out = df.unpivot(ids, cols, names_to, values_to)
    if strip_prefix:
        out = out.withColumn(names_to, F.regexp_replace(names_to, "^" + strip_prefix, ""))
    return out.filter(F.col(values_to).isNotNull()) if drop_nulls else out
