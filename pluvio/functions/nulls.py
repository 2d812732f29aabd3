"""The four sum rules and other null semantics of the source scripts.

* ``sum_keep_null``  all-null group -> null, else the sum of the known values
* ``sum_or_zero``    all-null group -> 0
* ``strict_sum``     any null in the group -> null
* ``row_total``      across columns: null only if every column is null
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_name(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Helpers below that receive column NAMES build one SQL expression: a single
# parse on the JVM side instead of several gateway calls per Column operation
# (generated over dozens of columns, the plan otherwise takes seconds to build).

def null_tokens(c, tokens) -> Column:
    """Text equal to one of ``tokens`` becomes null (read-time null strings)."""
    if isinstance(c, str):
        q = sql_name(c)
        return F.expr(f"CASE WHEN {q} IN ({', '.join(sql_text(t) for t in tokens)}) THEN NULL ELSE {q} END")
    return F.when(c.isin(list(tokens)), F.lit(None)).otherwise(c)


def sum_keep_null(c) -> Column:
    """Sum skipping nulls; a group with no known value stays null."""
    return F.sum(_c(c))


def sum_or_zero(c) -> Column:
    """Sum skipping nulls; a group with no known value gives 0."""
    return F.coalesce(F.sum(_c(c)), F.lit(0.0))


def strict_sum(c) -> Column:
    """Sum that is null as soon as one value of the group is null."""
    c = _c(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def r_if_else(cond: Column, yes, no) -> Column:
    """Two-way choice that yields null when the condition itself is null."""
    return F.when(cond, yes).when(~cond, no)


def row_null_count(cols) -> Column:
    return reduce(lambda a, b: a + b, [_c(c).isNull().cast("int") for c in cols])


def row_total(cols) -> Column:
    """Row-wise sum skipping nulls; null only if all ``cols`` are null."""
    cols = list(cols)
    if all(isinstance(c, str) for c in cols):
        qs = [sql_name(c) for c in cols]
        all_null = " AND ".join(f"{q} IS NULL" for q in qs)
        total = " + ".join(f"coalesce({q}, 0D)" for q in qs)
        return F.expr(f"CASE WHEN {all_null} THEN CAST(NULL AS DOUBLE) ELSE {total} END")
    total = reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0.0)) for c in cols])
    return F.when(row_null_count(cols) == len(cols), F.lit(None).cast("double")).otherwise(total)


def finite_or_null(c) -> Column:
    """NaN and +-Infinity become null."""
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def zero_fill(df: DataFrame, cols=None) -> DataFrame:
    """Null -> 0 on the numeric columns (or on ``cols``)."""
    cols = numeric_columns(df) if cols is None else list(cols)
    return df.fillna(0, subset=cols) if cols else df


def round_half(c, digits: int) -> Column:
    """Round a double half away from zero on ``x * 10^digits`` (the scaled value
    decides, as in common SQL engines), not on the exact binary expansion."""
    m = float(10 ** digits)
    if isinstance(c, str):
        return F.expr(f"round(CAST({sql_name(c)} AS DOUBLE) * {m!r}D, 0) / {m!r}D")
    return F.round(_c(c).cast("double") * m, 0) / m


def exact_sum(c, scale: int = 9) -> Column:
    """Sum accumulated as DECIMAL: independent of row order and partitioning, so
    a later rounding never flips between runs."""
    return F.sum(_c(c).cast(f"decimal(38,{scale})"))


def round_floats(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every float/double column (result publication and oracle comparison)
    with the ``round_half`` rule; one projection written as SQL text, so a wide
    table costs one call instead of several per column."""
    m = f"{float(10 ** digits)!r}D"
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(f"round(CAST({q} AS DOUBLE) * {m}, 0) / {m} AS {q}")
        else:
            exprs.append(q)
    return df.selectExpr(*exprs)
