"""A series as runs of present slots.

What coverage asks of a series — which bins and days hold data, how complete it is, where
its gaps are — follows from where its runs of consecutive slots begin and end. A run is
cut at midnight, so it is found within one (key, day); a device's runs of a day are at
most half its slots, usually one. Nothing here makes a row for a slot that isn't there:
a series of three readings a century apart has three runs.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.functions.dates import days_in_month, month_label, ntz_literal
from pluvio.operators.series import check_step


def _step(minutes: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def _minutes(a, b) -> Column:
    """Whole minutes from a to b."""
    return F.timestamp_diff("MINUTE", a, b)


def day_runs(series: DataFrame, keys=("device",), order: str = "slot", minutes: int = 15,
             value: str | None = None, day: str | None = None) -> DataFrame:
    """(keys, date, first, last, slots): the runs of consecutive slots of each key and day,
    of the slots with a known ``value`` if one is named. Slots are unique per key. ``day``
    names the column with the day of ``order``, if there is one."""
    check_step(minutes)
    x = series if value is None else series.filter(F.col(value).isNotNull())
    x = x.select(*keys, (F.to_date(order) if day is None else F.col(day)).alias("date"), F.col(order).alias("_at"))
    nth = F.row_number().over(Window.partitionBy(*keys, "date").orderBy("_at"))
    # slots in a row keep their distance to the row number
    island = F.floor(_minutes(F.col("date").cast("timestamp_ntz"), F.col("_at")) / minutes) - nth
    return (x.withColumn("_island", island).groupBy(*keys, "date", "_island")
            .agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.count(F.lit(1)).alias("slots")).drop("_island"))


def series_runs(by_day: DataFrame, keys=("device",), minutes: int = 15) -> DataFrame:
    """(keys, first, last, slots): ``day_runs`` put together across midnight. Its windows
    hold a key's runs, not its slots."""
    w = Window.partitionBy(*keys).orderBy("first")
    new = F.coalesce(F.col("first") != F.lag("last").over(w) + _step(minutes), F.lit(True))
    numbered = by_day.withColumn("_new", new.cast("int")).withColumn(
        "_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return numbered.groupBy(*keys, "_run").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum("slots").alias("slots")).drop("_run")


def gaps(whole: DataFrame, keys=("device",), minutes: int = 15) -> DataFrame:
    """(keys, gap_first, gap_last, slots): what lies between a key's ``series_runs``. The
    slot after a gap is the one that the published tables flag."""
    w = Window.partitionBy(*keys).orderBy("first")
    x = whole.select(*keys, (F.col("last") + _step(minutes)).alias("gap_first"),
                     (F.lead("first").over(w) - _step(minutes)).alias("gap_last")).filter(F.col("gap_last").isNotNull())
    return x.withColumn("slots", (_minutes(F.col("gap_first"), F.col("gap_last")) / minutes + 1).cast("bigint"))


def bin_counts(by_day: DataFrame, anchor: Column, keys=("device",), minutes: int = 15, bin_minutes: int = 480) -> DataFrame:
    """(keys, date, bin_start, count) of the bins of ``bin_minutes`` from ``anchor`` on that
    hold a slot of ``day_runs``; a bin that crosses midnight is split by the day."""
    lo, hi = (F.floor(_minutes(anchor, F.col(c)) / bin_minutes) for c in ("first", "last"))
    x = by_day.withColumn("_bin", F.explode(F.sequence(lo, hi)))
    # slots of the run from the first to the last minute of the bin
    from_ = F.col("_bin") * bin_minutes - _minutes(anchor, F.col("first"))
    upto = from_ + bin_minutes - 1
    n = (F.least(F.floor(upto / minutes), F.col("slots") - 1) - F.greatest(F.ceil(from_ / minutes), F.lit(0)) + 1).cast("bigint")
    return (x.withColumn("_n", n).groupBy(*keys, "date", "_bin").agg(F.sum("_n").alias("count"))
            .filter("count > 0").select(*keys, "date", _bin_start(anchor, bin_minutes).alias("bin_start"), "count"))


def _bin_start(anchor: Column, bin_minutes: int) -> Column:
    return F.timestamp_add("MINUTE", (F.col("_bin") * bin_minutes).cast("int"), anchor)


def _span(devices: DataFrame, first, last_day):
    """The keys and bounds of the days from ``first`` to the day before ``last_day``; no
    keys if there are none."""
    if first is not None and first.date() < last_day:
        return devices, first, last_day
    return devices.filter(F.lit(False)), dt.datetime(2000, 1, 1), dt.date(2000, 1, 2)


def all_bins(devices: DataFrame, first, last_day, keys=("device",), minutes: int = 15, bin_minutes: int = 480) -> DataFrame:
    """(keys, date, bin_start): every bin that slots from ``first`` to the day before
    ``last_day`` could lie in, for every key: a few rows a day."""
    devices, first, last_day = _span(devices, first, last_day)
    anchor, end = ntz_literal(first), F.lit(last_day)
    days = devices.select(
        *keys, F.explode(F.sequence(F.to_date(anchor), F.date_sub(end, 1))).alias("date"))
    start = F.greatest(F.col("date").cast("timestamp_ntz"), anchor)
    last = F.col("date").cast("timestamp_ntz") + _step(1440 - minutes)
    lo, hi = (F.floor(_minutes(anchor, t) / bin_minutes) for t in (start, last))
    return days.withColumn("_bin", F.explode(F.sequence(lo, hi))).select(*keys, "date", _bin_start(anchor, bin_minutes).alias("bin_start"))


def usable_days(counts: DataFrame, keys=("device",), min_bins: int = 1) -> DataFrame:
    """(keys, date) of the days of which more than ``min_bins`` bins hold data."""
    return counts.groupBy(*keys, "date").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_bins).drop("_n")


def month_coverage(usable: DataFrame, devices: DataFrame, first, last_day, keys=("device",)) -> DataFrame:
    """Usable days per (key, year, month) and their percent of the month's calendar days,
    for every key and every month from ``first`` to the day before ``last_day``."""
    devices, first, last_day = _span(devices, first, last_day)
    lo, end = F.to_date(ntz_literal(first)), F.lit(last_day)
    month = F.make_ym_interval(F.lit(0), F.lit(1))
    every = devices.select(*keys, F.explode(F.sequence(F.trunc(lo, "month"), F.trunc(F.date_sub(end, 1), "month"), month)).alias("_month"))
    n = usable.groupBy(*keys, F.trunc("date", "month").alias("_month")).agg(F.count(F.lit(1)).alias("count"))
    m = every.join(n, on=[*keys, "_month"], how="left").select(
        *keys, F.year("_month").alias("year"), F.month("_month").alias("month_num"), month_label("_month").alias("month"),
        F.coalesce("count", F.lit(0)).cast("bigint").alias("count"), days_in_month("_month").alias("number_of_days"))
    return m.withColumn("percent", F.col("count") / F.col("number_of_days") * 100)


def completeness(by_day: DataFrame, devices: DataFrame, first, last_day, keys=("device",), minutes: int = 15) -> DataFrame:
    """Per key: slots expected on the days from ``first`` to the day before ``last_day``,
    slots present (the lengths of the runs), percent."""
    devices, first, last_day = _span(devices, first, last_day)
    days = F.date_diff(F.lit(last_day), F.to_date(ntz_literal(first)))
    n = by_day.groupBy(*keys).agg(F.sum("slots").alias("available_data"))
    c = devices.join(n, on=list(keys), how="left").select(
        *keys, (days * (1440 // check_step(minutes))).cast("bigint").alias("total_data"),
        F.coalesce("available_data", F.lit(0)).cast("bigint").alias("available_data"))
    return c.withColumn("percent", F.col("available_data") / F.col("total_data") * 100)
