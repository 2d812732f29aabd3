"""Irregular sensor series: time buckets, counter differencing, dense grids,
full-window rolling sums, daily and hourly roll-ups.

Series are kept long — (device, slot, value) — and every window is partitioned
by (device, day), never by device alone: one device may hold a third of all rows,
and a per-device window would put all of them into one task. Where a result needs
the row before a day's first row, that row is joined from a small per-(device, day)
summary (see ``lag_in_series``). A table that is stored by (device, day), with the day as
a column, passes all of these without an exchange.
"""
from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions import exact
from pluvio.functions.dates import floor_minutes, ntz_literal
from pluvio.functions.nulls import sql_name
from pluvio.operators.joins import scalar

DAY = "date"


def check_step(minutes: int) -> int:
    """``minutes`` if slots of that length start at every midnight."""
    if minutes < 1 or 1440 % minutes:
        raise ValueError(f"slots of {minutes} minutes don't divide a day")
    return minutes


def _interval_minutes(minutes: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def slot_summary(readings: DataFrame, keys=("device",), ts: str = "ts",
                 minutes: int = 15, means: dict[str, str] | None = None,
                 aggs: dict[str, Column] | None = None) -> DataFrame:
    """Group readings into ``minutes`` buckets per key: one aggregation (with
    map-side partial aggregation) producing every per-slot measure at once.
    ``means`` maps an output name to the column it is the mean of (null values skipped,
    an all-null slot stays null), the same whatever the order of the readings; ``aggs``
    maps further output names to aggregates. Readings without a time are left out."""
    return summarised(readings.filter(F.col(ts).isNotNull()).withColumn("slot", floor_minutes(ts, minutes)),
                      (*keys, "slot"), means or {"value": "value"}, aggs)


def summarised(rows: DataFrame, keys, means: dict[str, str], aggs: dict[str, Column] | None = None) -> DataFrame:
    """One aggregation with order-independent ``means`` and other aggregates."""
    sums = [a for out, c in means.items() for a in exact.sums(sql_name(c), out)]
    g = rows.groupBy(*keys).agg(*[a.alias(n) for n, a in (aggs or {}).items()], *sums)
    return exact.with_means(g, *means).select(*keys, *means, *(aggs or {}))


def bucket_mean(readings: DataFrame, keys=("device",), ts="ts", value="value",
                minutes: int = 15) -> DataFrame:
    """Mean of ``value`` per key and ``minutes`` bucket."""
    return slot_summary(readings, keys, ts, minutes, {value: value})


def lag_in_series(df: DataFrame, keys, order: str, cols, prefix: str = "prev_", day: str | None = None) -> DataFrame:
    """Add ``prefix + c``: the value of ``c`` in the previous existing row of the
    same series (by ``order``), like ``lag`` over a per-key window. Keys are not null.

    Computed in (keys, day) partitions: a day's first row gets the last row of the most
    recent earlier day that has rows, from a per-(keys, day) summary whose
    size is the number of days, not of readings. A gap spanning days is honoured
    (the previous row may be days earlier) and nulls are kept (no ignore-nulls). ``day``
    names the column with the day of ``order``, if there is one: a table laid out by keys
    and day is then not exchanged."""
    keys, cols = list(keys), list(cols)
    own = day or "_lag_day"
    x = df if day else df.withColumn(own, F.to_date(order))
    # values, no struct maximum: the aggregation stays a hash aggregation
    last = x.groupBy(*keys, own).agg(*[F.max_by(c, order).alias(f"_v{i}") for i, c in enumerate(cols)])
    packed = F.struct(*[F.col(f"_v{i}") for i in range(len(cols))])
    before = last.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, own])],
                         F.lag(packed).over(Window.partitionBy(*keys).orderBy(own)).alias("_before"))
    out = _lag_with(x, keys, own, order, cols, prefix, before.filter(F.col("_before").isNotNull()))
    return out if day else out.drop(own)


def _lag_with(x: DataFrame, keys: list, day: str, order: str, cols: list, prefix: str, before: DataFrame) -> DataFrame:
    """Lag within (keys, day), and for a day's first row the values ``_before`` of
    ``before`` (keys and day as _k0, _k1 and so on)."""
    w = Window.partitionBy(*keys, day).orderBy(order)
    body = x.select("*", *[F.lag(c).over(w).alias(prefix + c) for c in cols], F.lag(F.lit(True)).over(w).alias("_later"))
    same = functools.reduce(operator.and_, [F.col(c) == F.col(f"_k{i}") for i, c in enumerate([*keys, day])])
    j = body.join(before, same, "left")
    return j.select(*x.columns, *[F.when(F.col("_later"), F.col(prefix + c)).otherwise(F.col(f"_before._v{i}")).alias(prefix + c)
                                  for i, c in enumerate(cols)])


def lag_on_grid(df: DataFrame, keys, order: str, cols, minutes: int, prefix: str = "prev_", day: str | None = None) -> DataFrame:
    """``lag_in_series`` for a dense grid of ``minutes`` slots (every slot of every
    day between the bounds is a row): the row before a day's first slot is that
    key's last slot of the previous day, so what a first row needs is just those rows
    moved one day on — no per-day summary and no per-key window."""
    check_step(minutes)
    keys, cols = list(keys), list(cols)
    own = day or "_lag_day"
    x = df if day else df.withColumn(own, F.to_date(order))
    last = F.col(own).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1440 - minutes))
    before = x.filter(F.col(order) == last).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], F.date_add(own, 1).alias(f"_k{len(keys)}"),
        F.struct(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)]).alias("_before"))
    out = _lag_with(x, keys, own, order, cols, prefix, before)
    return out if day else out.drop(own)


def counter_diff(series: DataFrame, keys=("device",), order: str = "slot", value: str = "value",
                 out: str = "interval", clamp: bool = True, keep_raw: str | None = None,
                 day: str | None = None) -> DataFrame:
    """Cumulative counter -> per-interval amount: value minus the previous existing
    row's value. A null on either side gives null. With ``clamp`` negative
    differences (counter resets) become 0; ``keep_raw`` names a column that keeps
    the unclamped difference. Means of equal readings are equal to the last bit (see
    ``functions.exact``), so a flat counter has no rain and no reset."""
    d = lag_in_series(series, keys, order, [value], prefix="_prev_", day=day)
    d = d.withColumn(out, F.col(value) - F.col(f"_prev_{value}"))
    if keep_raw:
        d = d.withColumn(keep_raw, F.col(out))
    if clamp:
        d = d.withColumn(out, F.when(F.col(out) < 0, F.lit(0.0)).otherwise(F.col(out)))
    return d.drop(f"_prev_{value}")


def time_grid(series: DataFrame, keys=("device",), order: str = "slot", minutes: int = 15,
              bounds=None) -> DataFrame:
    """Every ``minutes`` slot between the first and the last slot of the whole
    series, for every key present. Bounds come from one scalar subquery (or are
    given, when a smaller table already knows them); slots are generated per
    (key, day), so no row ever holds more than a day of slots."""
    check_step(minutes)
    keys = list(keys)
    if bounds is None:
        b = scalar(series, F.struct(F.min(order).alias("lo"), F.max(order).alias("hi")))
        lo, hi = b.getField("lo"), b.getField("hi")
    else:
        lo, hi = (ntz_literal(v) for v in bounds)
    days = (series.select(*keys).distinct()
            .select(*keys, F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias("_d")))
    start = F.col("_d").cast("timestamp_ntz")
    last = start + F.make_dt_interval(F.lit(0), F.lit(23), F.lit(60 - minutes))
    slots = F.sequence(F.greatest(start, lo), F.least(last, hi), _interval_minutes(minutes))
    return days.select(*keys, F.explode(slots).alias(order))


def densify(series: DataFrame, keys=("device",), order: str = "slot", minutes: int = 15,
            bounds=None, day: str | None = None) -> DataFrame:
    """The series on its complete grid: missing slots appear as rows of nulls. Slots lie
    on the grid and keys are not null.

    A row makes the rows of the empty slots up to the next one of its day, a day's first
    row also those before it; no join with a grid of slots is needed. With ``day`` (the
    column with the day of ``order``) a table laid out by keys and day is not exchanged."""
    check_step(minutes)
    keys, own = list(keys), day or "_day"
    x = series if day else series.withColumn(own, F.to_date(order))
    if bounds is None:
        b = scalar(series, F.struct(F.min(order).alias("lo"), F.max(order).alias("hi")))
        lo, hi = b.getField("lo"), b.getField("hi")
    else:
        lo, hi = (ntz_literal(v) for v in bounds)
    step = _interval_minutes(minutes)
    # every day of every key, with its rows or one without a slot: the days are few, and the
    # rows stay where they are if they are laid out by key and day
    every = series.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias(own))
    x = every.hint("merge").join(x.hint("merge"), [*keys, own], "left")
    w = Window.partitionBy(*keys, own).orderBy(order)
    start = F.greatest(F.col(own).cast("timestamp_ntz"), lo)
    end = F.least(F.col(own).cast("timestamp_ntz") + _interval_minutes(1440 - minutes), hi)
    values = [c for c in x.columns if c not in (*keys, own, order)]
    first = F.lag(order).over(w).isNull()
    out = (x.withColumns({"_first": first, "_next": F.lead(order).over(w)})
           .withColumn("_at", F.explode(F.sequence(F.when(F.col("_first"), start).otherwise(F.col(order)),
                                                   F.greatest(F.col(order), F.coalesce(F.col("_next") - step, end)), step)))
           .select(*keys, F.col("_at").alias(order), own, *[F.when(F.col("_at") == F.col(order), F.col(c)).alias(c) for c in values]))
    return out if day else out.drop(own)


def with_day(df: DataFrame, order: str = "slot", name: str = DAY) -> DataFrame:
    return df.withColumn(name, F.to_date(order))


def drop_last_day(df: DataFrame, order: str = "slot", last_day=None) -> DataFrame:
    """Keep rows strictly before the last calendar day present (a partial day);
    ``last_day`` may be given when it is already known."""
    cut = scalar(df, F.max(F.to_date(order))) if last_day is None else F.lit(last_day)
    return df.filter(F.col(order) < cut)


def rolling_full_window_sum(df: DataFrame, value: str, out: str, keys=("device",),
                            order: str = "slot", width: int = 12, day: str = DAY) -> DataFrame:
    """Right-aligned sum over ``width`` rows restarting each (key, day): null until
    the window is full; inside a full window nulls are skipped and an all-null
    window gives 0."""
    if day not in df.columns:
        df = with_day(df, order, day)
    w = Window.partitionBy(*keys, day).orderBy(order).rowsBetween(-(width - 1), 0)
    full = F.count(F.lit(1)).over(w) == width
    return df.withColumn(out, F.when(full, F.coalesce(F.sum(value).over(w), F.lit(0.0))))


def daily_rain(df: DataFrame, keys=("device",), value: str = "interval",
               rolling: str = "max_3_hour", day: str = DAY) -> DataFrame:
    """Per (day, key): the day's total (null when no value is known) and the
    largest rolling sum, nulled whenever the total is null."""
    g = df.groupBy(day, *keys).agg(F.sum(value).alias("interval"),
                                   F.max(rolling).alias("max_3_hr_interval"))
    return g.withColumn("max_3_hr_interval",
                        F.when(F.col("interval").isNotNull(), F.col("max_3_hr_interval")))


def hourly_sum(df: DataFrame, keys=("device",), order: str = "slot", value: str = "interval",
               out: str = "precipitation") -> DataFrame:
    """Per (key, clock hour): null-preserving sum."""
    return df.groupBy(*keys, floor_minutes(order, 60).alias("datehour")).agg(
        F.sum(value).alias(out))
