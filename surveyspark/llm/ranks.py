"""Row numbers over a whole table without a window that holds a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.llm.common import stored
from surveyspark.session import broadcast_if_small


def ranked(df: DataFrame, group: str, order: list[Column], rank: str = "rank", size: str = "size") -> DataFrame:
    """``df`` with the row number (from 0, long) of each row in its ``group`` by ``order``, and the group's rows.

    Spark sorts by ranges of (group, order); a row's place is its place in its range plus the rows of its group in
    earlier ranges, and only the counts per (group, range) meet in a window: a group that holds most rows lies in
    many ranges. ``group`` must not be null. Rows that agree in ``order`` are numbered one after the other in any
    order; they may lie in several ranges."""
    here = F.col("_at")
    keys = [F.col(group), *order, F.monotonically_increasing_id()]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(F.col(group), *order).withColumn("_at", F.monotonically_increasing_id())
    laid = stored(laid, "ranked").withColumn("_range", F.shiftright(here, 33))
    counts = stored(laid.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"), F.min(here).alias("_first")), "rank-counts")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy(group)).alias(size)
    )  # at most a row for each group and each range
    starts = stored(starts, "rank-starts")
    return laid.join(broadcast_if_small(starts), [group, "_range"]).withColumn(rank, here + F.col("_shift")).drop("_at", "_range", "_shift")
