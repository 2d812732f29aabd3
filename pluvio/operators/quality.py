"""Data-quality rules: anomaly masking, counter-reset flags, gap flags, missing
flags and period flags. Texts are fixed values of the published tables."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.functions.nulls import r_if_else
from pluvio.operators.series import lag_in_series, lag_on_grid

# fixed values: flag texts of the published tables
ANOMALY_TEXT = "Value suspected to be anomalous; removed"
RESET_TEXT = "Value anomalous; removed."
GAP_TEXT = "There is gap in previous data"
MISSING_TEXT = "Missing"
BEFORE_START_TEXT = "-"
AFTER_END_TEXT = "Data were not collected due to COVID 19"
STATION_MISSING_TEXT = "missing"
TRACE_TEXT = "Trace"
OFFICIAL_MISSING_TEXT = "Missing data"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dates(ds) -> list:
    return [d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)) for d in ds]


def anomaly_condition(ts, value, dates, low: float, high: float) -> Column:
    """On the listed dates only, a value above ``high`` or below ``low`` is
    anomalous. A null value is never flagged (the condition is null)."""
    v = _c(value)
    return F.to_date(_c(ts)).isin(_dates(dates)) & ((v > high) | (v < low))


def anomaly_mask(df: DataFrame, dates, low: float, high: float, ts: str = "ts",
                 value: str = "value", flag: str = "quality") -> DataFrame:
    """Null the anomalous values and keep the reason in ``flag``."""
    cond = anomaly_condition(ts, value, dates, low, high)
    return df.withColumns({
        flag: r_if_else(cond, F.lit(ANOMALY_TEXT), F.lit(None).cast("string")),
        value: r_if_else(cond, F.lit(None).cast("double"), F.col(value)),
    })


def flagged_rows(df: DataFrame, keys=("device",), order: str = "slot", flag: str = "quality") -> DataFrame:
    """Side table of the rows that carry a flag."""
    return df.select(*keys, order, flag).filter(F.col(flag).isNotNull())


def reset_flags(diffs: DataFrame, keys=("device",), order: str = "slot",
                raw_diff: str = "raw_interval", clamped: str = "interval",
                flag_before_clamp: bool = False) -> DataFrame:
    """Slots whose counter went down. With ``flag_before_clamp=False`` the test
    reads the already-clamped value, which is never negative — the published
    tables therefore never carry this flag; ``True`` tests the raw difference."""
    col = raw_diff if flag_before_clamp else clamped
    return (diffs.filter(F.col(col) < 0)
            .select(*keys, order, F.lit(RESET_TEXT).alias("quality")))


def merge_flags(*flag_tables: DataFrame, keys=("device",), order: str = "slot") -> DataFrame:
    """Union of flag tables reduced to one flag per (key, slot) (smallest text)."""
    u = flag_tables[0]
    for t in flag_tables[1:]:
        u = u.unionByName(t)
    return u.groupBy(*keys, order).agg(F.min("quality").alias("quality"))


def gap_flag(grid: DataFrame, keys=("device",), order: str = "slot", value: str = "accumulated",
             flag: str = "quality", step_minutes: int | None = None, day: str | None = None) -> DataFrame:
    """On a dense grid: a present value whose previous slot has no value marks a
    gap (the first slot of a series counts as following a gap). An existing flag
    wins over the gap flag. ``step_minutes`` (the grid step) lets the previous slot
    come from the cheaper dense-grid lookup."""
    if step_minutes:
        g = lag_on_grid(grid, keys, order, [value], step_minutes, prefix="_gp_", day=day)
    else:
        g = lag_in_series(grid, keys, order, [value], prefix="_gp_", day=day)
    gap = F.col(value).isNotNull() & F.col(f"_gp_{value}").isNull()
    text = F.when(gap, F.lit(GAP_TEXT))
    base = F.col(flag) if flag in grid.columns else F.lit(None).cast("string")
    return g.withColumn(flag, F.coalesce(base, text)).drop(f"_gp_{value}")


def null_first_slot(df: DataFrame, order: str = "slot", flag: str = "quality", first=None) -> DataFrame:
    """The table's first slot never carries a flag. ``first`` may be given (a
    value or scalar column) when a smaller table already knows it."""
    if first is None:
        first = df.select(F.min(order)).scalar()
    return df.withColumn(flag, F.when(F.col(order) != first, F.col(flag)))


def missing_flag(df: DataFrame, value: str, flag: str = "quality") -> DataFrame:
    """'Missing' where neither a value nor a flag is present."""
    return df.withColumn(flag, F.when(F.col(flag).isNull() & F.col(value).isNull(),
                                      F.lit(MISSING_TEXT)).otherwise(F.col(flag)))


def station_flag(ts, probe, start, end) -> Column:
    """Ordered rule for a station column ``probe``: before ``start`` and empty ->
    '-', after ``end`` and empty -> the not-collected text, empty -> 'missing'."""
    ts, probe = _c(ts), _c(probe)
    start, end = _dates([start, end])
    empty = probe.isNull()
    return (F.when((ts < F.lit(start)) & empty, F.lit(BEFORE_START_TEXT))
            .when((ts > F.lit(end)) & empty, F.lit(AFTER_END_TEXT))
            .when(empty, F.lit(STATION_MISSING_TEXT)))


def official_flag(date, rain, trace_flag, start) -> Column:
    """Ordered rule for an official series: trace, before ``start`` '-', empty ->
    'Missing data'."""
    (start,) = _dates([start])
    return (F.when(_c(trace_flag) == TRACE_TEXT, F.lit(TRACE_TEXT))
            .when(_c(date) < F.lit(start), F.lit(BEFORE_START_TEXT))
            .when(_c(rain).isNull(), F.lit(OFFICIAL_MISSING_TEXT)))
