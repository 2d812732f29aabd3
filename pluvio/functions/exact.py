"""Sums and means of doubles that don't depend on the order of the rows.

A double below 2^31 is split into three whole numbers: the integer part and the fraction
in steps of 2^-32 and 2^-64 (what is smaller still is cut off, for a value alike wherever
it stands). Their sums are BIGINTs in the buffers of a hash aggregation, exact for up to
2^31 rows a group, and are put together once a group, as one DECIMAL(38, 0) in steps of
2^-64. A mean is corrected by what its own double leaves over, so equal values have one
mean however many they are: their own value, if it has no digits below 2^-64. Larger and
non-finite values are added up as they are.

``sums`` makes the aggregates under hidden names; ``with_totals`` and ``with_means`` turn
them into the result in projections of their own, which keeps the aggregation in generated
code.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT = "2147483648D"
SMALLEST = f"{2.0 ** -64!r}D"


def _parts(x: str) -> list[str]:
    """The three parts of a double (SQL); null where it is too large or not finite."""
    v = f"(CASE WHEN abs({x}) < {LIMIT} THEN {x} END)"
    one = f"CAST({v} AS BIGINT)"
    scaled = f"(({v} - CAST({one} AS DOUBLE)) * 4294967296D)"
    lo = f"CAST({scaled} AS BIGINT)"
    return [one, lo, f"CAST(({scaled} - CAST({lo} AS DOUBLE)) * 4294967296D AS BIGINT)"]


def _steps(one: str, lo: str, rest: str) -> str:
    """Three parts as a number of steps (SQL)."""
    two32 = "CAST(4294967296 AS DECIMAL(10, 0))"
    a, b, c = (f"CAST(coalesce({x}, 0L) AS DECIMAL(19, 0))" for x in (one, lo, rest))
    return f"CAST(({a} * {two32} + {b}) * {two32} + {c} AS DECIMAL(38, 0))"


def _double(steps: str) -> str:
    return f"(CAST({steps} AS DOUBLE) * {SMALLEST})"


def _names(out: str) -> list[str]:
    return [f"`_{out}_{p}`" for p in ("one", "lo", "rest", "far", "n", "steps", "about")]


def sums(x: str, out: str) -> list[Column]:
    """The aggregates behind the total or mean ``out`` of ``x`` (SQL of a double)."""
    one, lo, rest, far, n, _, _ = _names(out)
    aggs = [f"sum({part}) AS {name}" for name, part in zip((one, lo, rest), _parts(x))]
    aggs += [f"sum(CASE WHEN NOT abs({x}) < {LIMIT} THEN {x} END) AS {far}", f"count({x}) AS {n}"]
    return [F.expr(a) for a in aggs]


def _with(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name.strip("`"): F.expr(e) for name, e in columns.items()})


def _totalled(df: DataFrame, outs) -> DataFrame:
    names = {out: _names(out) for out in outs}
    return _with(df, {steps: _steps(one, lo, rest) for one, lo, rest, _, _, steps, _ in names.values()})


def _total(far: str, n: str, steps: str) -> str:
    return f"CASE WHEN {n} > 0 THEN CASE WHEN {far} IS NULL THEN {_double(steps)} ELSE {far} + {_double(steps)} END END"


def _finished(df: DataFrame, outs, values: dict[str, str]) -> DataFrame:
    return _with(df, values).drop(*[c.strip("`") for out in outs for c in _names(out)])


def with_totals(df: DataFrame, *outs: str) -> DataFrame:
    """``df`` with the total of each of ``outs``, null where no value is known."""
    df = _totalled(df, outs)
    return _finished(df, outs, {out: _total(*(_names(out)[i] for i in (3, 4, 5))) for out in outs})


def with_means(df: DataFrame, *outs: str) -> DataFrame:
    """``df`` with the mean of each of ``outs``, null where no value is known."""
    df = _totalled(df, outs)
    df = _with(df, {_names(out)[6]: f"({_total(*(_names(out)[i] for i in (3, 4, 5)))}) / nullif({_names(out)[4]}, 0)" for out in outs})
    values = {}
    for out in outs:
        *_, far, n, steps, about = _names(out)
        own = _steps(*_parts(about))
        over = f"CAST({steps} - CAST({n} AS DECIMAL(10, 0)) * {own} AS DECIMAL(38, 0))"
        values[out] = f"CASE WHEN {far} IS NULL AND abs({about}) < {LIMIT} THEN {_double(own)} + {_double(over)} / {n} ELSE {about} END"
    return _finished(df, outs, values)
