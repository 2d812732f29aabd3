"""Coverage and frequency statistics of the gridded series."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions.dates import anchored_bin, days_in_month, floor_minutes, month_label
from pluvio.operators.running import running_sum


def monthly_day_count(daily_long: DataFrame, keys=("device",), date: str = "date",
                      value: str = "rain") -> DataFrame:
    """Days with a known daily value per (year, month, key)."""
    x = daily_long.filter(F.col(value).isNotNull())
    return x.groupBy(F.year(date).alias("year"), F.month(date).alias("month_num"), month_label(date).alias("month"),
                     *keys).agg(F.count(F.lit(1)).alias("day_count"))


def bin_availability(grid: DataFrame, keys=("device",), order: str = "slot", value: str = "interval",
                     minutes: int = 480, first=None) -> DataFrame:
    """Count of known values per (bin, day, key). Bins are ``minutes`` long and
    anchored at the table's first timestamp (``first`` if it is known already) cut to
    the minute; a bin that crosses midnight is split by the day."""
    if first is None:
        anchor = grid.agg(F.min(order).alias("_m")).select(floor_minutes("_m", 1)).scalar()
    else:
        anchor = floor_minutes(first, 1)
    return (grid.groupBy(anchored_bin(order, anchor, minutes).alias("bin_start"),
                         F.to_date(order).alias("date"), *keys)
            .agg(F.count(value).alias("count"))
            .withColumn("available", F.when(F.col("count") > 0, "yes").otherwise("no")))


def usable_days(bins: DataFrame, keys=("device",), min_bins: int = 1) -> DataFrame:
    """A day is usable when more than ``min_bins`` of its bins hold data."""
    return bins.groupBy("date", *keys).agg(
        F.when(F.count_if(F.col("available") == "yes") > min_bins, 1).otherwise(0).alias("useable"))


def month_coverage(bins: DataFrame, keys=("device",), min_bins: int = 1) -> DataFrame:
    """Usable days per (key, year, month) and their percent of the month's calendar days."""
    u = usable_days(bins, keys, min_bins)
    m = u.groupBy(*keys, F.year("date").alias("year"), F.month("date").alias("month_num"), month_label("date").alias("month")).agg(
        F.sum("useable").cast("bigint").alias("count"),
        F.max(days_in_month("date")).alias("number_of_days"))
    return m.withColumn("percent", F.col("count") / F.col("number_of_days") * 100)


def device_completeness(bins: DataFrame, keys=("device",), slot_minutes: int = 15) -> DataFrame:
    """Per key: days x readings-per-day expected, readings present, percent."""
    per_day = 24 * 60 // slot_minutes
    daily = bins.groupBy(*keys, "date").agg(F.sum("count").alias("count"))
    return (daily.groupBy(*keys).agg((F.count(F.lit(1)) * per_day).alias("total_data"),
                                     F.sum("count").alias("available_data"))
            .withColumn("percent", F.col("available_data") / F.col("total_data") * 100))


def column_completeness(daily: DataFrame, value_cols: dict[str, str],
                        flag_cols: dict[str, str]) -> DataFrame:
    """One row: rounded percent of days with a value (``{out: column}``) and
    rounded percent of days without a flag (``{out: flag column}``)."""
    n = F.count(F.lit(1))
    aggs = [F.round(F.count(F.col(f"`{c}`")) / n * 100).alias(o) for o, c in value_cols.items()]
    aggs += [F.round(F.count_if(F.col(f"`{c}`").isNull()) / n * 100).alias(o) for o, c in flag_cols.items()]
    return daily.agg(*aggs)


def frequency_table(long: DataFrame, keys=("device",), value: str = "interval",
                    digits: int | None = None) -> DataFrame:
    """Per key: each distinct known value with its count, percent of the key's
    known values, and running count / percent in order of count (desc) then value.
    ``digits`` rounds values before counting."""
    v = F.col(value) if digits is None else F.round(value, digits)
    counts = (long.filter(F.col(value).isNotNull()).groupBy(*keys, v.alias("item"))
              .agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy(*keys).agg(F.sum("count").alias("_total"))
    x = counts.join(totals, on=list(keys), how="inner")
    x = running_sum(x, keys, [F.col("count").desc(), F.col("item").asc()], "count", "cum_count")
    return x.select(*keys, "item", "count", (F.col("count") / F.col("_total") * 100).alias("percent"),
                    "cum_count", (F.col("cum_count") / F.col("_total") * 100).alias("cum_percent"))
