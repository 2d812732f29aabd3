"""Generated tables: daily calendars (time grids live in operators.series)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar(spark: SparkSession, start: str, end: str, name: str = "date") -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(name))


def calendar_over(dated: DataFrame, date: str, name: str = "date") -> DataFrame:
    """One row per day from the first to the last ``date`` of ``dated``, however many
    years these span; no row without a date."""
    span = dated.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias(name))
