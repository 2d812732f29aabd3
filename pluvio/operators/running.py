"""Running (prefix) totals that never gather a whole group into one task.

A per-group window ordered inside the group puts every row of the group into a
single task; a hot group (a third of the table) then runs alone. Here the rows
are range-partitioned on (group, order) so one group spreads over many tasks;
each task sums its own slice, the slice totals (one row per task and group) give
the offsets, and a join adds them back. Work per task stays bounded whatever the
group sizes. The slice assignment of a range exchange fed by a shuffle is not
reproducible (sampling sees rows in fetch order), so the tagged rows are pinned
with a reliable checkpoint before the two consumers read them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.session import pin


def running_sum(df: DataFrame, groups, order, value: str, out: str,
                partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per ``groups`` in ``order`` (a list of
    Columns or names that is unique within a group)."""
    groups = list(groups)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *[F.col(g) for g in groups], *order)
    # both consumers below must see the same row -> slice assignment: pin it
    tagged = pin(ranged.withColumn("_rp", F.spark_partition_id()))
    upto = Window.unboundedPreceding
    local_w = Window.partitionBy("_rp", *groups).orderBy(*order).rowsBetween(upto, Window.currentRow)
    local = tagged.withColumn("_local", F.sum(value).over(local_w))
    blocks = tagged.groupBy(*groups, "_rp").agg(F.sum(value).alias("_blk"))
    prior = Window.partitionBy(*groups).orderBy("_rp").rowsBetween(upto, -1)
    offsets = blocks.select(*groups, "_rp", F.coalesce(F.sum("_blk").over(prior), F.lit(0)).alias("_off"))
    joined = local.join(offsets, on=[*groups, "_rp"], how="inner")
    return joined.withColumn(out, F.col("_local") + F.col("_off")).drop("_rp", "_local", "_off")
