"""Exact ranks over all rows of a group, however large, without a window over the group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pooled_rank(df: DataFrame, groups: list[str], column: str, name: str = "rank", ranges: int = 256) -> DataFrame:
    """``df`` with the average-tie rank (from 1) of ``column`` among the group's rows that have a value; missing ones have none.

    Equal values are counted first, so ties, however many, are one row. The distinct values are cut into ranges at approximate
    quantiles of the group: every range is ranked by itself and starts where the ones below it end. The cuts only decide how
    evenly the work is dealt, not the result, and a value lies in one range, so no tie crosses a border.
    """
    values = df.filter(F.col(column).isNotNull()).groupBy(*groups, column).agg(F.count("*").alias("_n"))
    marks = F.array(*(F.lit(k / ranges) for k in range(1, ranges)))
    cuts = values.groupBy(*groups).agg(F.array_distinct(F.percentile_approx(column, marks, F.lit(20 * ranges))).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(column)))
    placed = values.join(cuts, groups).select(*groups, column, "_n", below.alias("_range"))
    # As many rows as there are groups and ranges.
    sizes = placed.groupBy(*groups, "_range").agg(F.sum("_n").alias("_size"))
    upto = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*groups, "_range", F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, "_range").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("_upto", F.sum("_n").over(within)).join(starts, [*groups, "_range"])
    rank = (F.col("_start") + F.col("_upto") - (F.col("_n") - 1) / 2).alias(name)
    return df.join(ranked.select(*groups, column, rank), [*groups, column], "left").select(*df.columns, name)
