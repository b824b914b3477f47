"""Streaks and event studies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_entity():
    return Window.partitionBy("entity").orderBy("dt")


def signed_streak(flows: DataFrame, column: str = "value") -> DataFrame:
    """(entity, dt, streak): length of the run of equal direction so far, negative where the flow is not positive."""
    way = F.when(F.col(column) > 0, 1).otherwise(-1)
    turns = flows.select("entity", "dt", way.alias("way"), F.lag(way).over(by_entity()).alias("before"))
    island = turns.select("entity", "dt", "way", F.sum(F.when(F.col("way").eqNullSafe(F.col("before")), 0).otherwise(1)).over(by_entity()).alias("island"))
    run = F.row_number().over(Window.partitionBy("entity", "island").orderBy("dt"))
    return island.select("entity", "dt", (run * F.col("way")).alias("streak"))


def boards(hits: DataFrame) -> DataFrame:
    """(entity, dt, board_count): how many days in a row (calendar days, so weekends break) the entity has been hit."""
    days = hits.select("entity", "dt").distinct()
    start = F.when(F.datediff("dt", F.lag("dt").over(by_entity())) == 1, 0).otherwise(1)
    island = days.select("entity", "dt", start.alias("start")).select("entity", "dt", F.sum("start").over(by_entity()).alias("island"))
    return island.select("entity", "dt", F.row_number().over(Window.partitionBy("entity", "island").orderBy("dt")).alias("board_count"))


def board_types(board: DataFrame) -> DataFrame:
    """Kinds of days by their count: first board or board in a row, with their numbers."""
    kind = F.when(F.col("board_count") == 1, "first").otherwise("consecutive")
    return board.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.max("board_count").alias("longest"))


#: Marks of the limit list. The limit held to the close, and it was reached but broken.
HELD, BROKEN = "Z", "U"


def limit_kinds(limits: DataFrame) -> DataFrame:
    """``limits`` (entity, dt, lim, ...) with board_count (of days whose limit held) and kind: first board, consecutive ones,
    broken, or other."""
    counted = limits.join(boards(limits.filter(F.col("lim") == HELD)).withColumn("lim", F.lit(HELD)), ["entity", "dt", "lim"], "left")
    kind = F.when(F.col("lim") == HELD, F.when(F.col("board_count") > 1, "consecutive").otherwise("first")).when(F.col("lim") == BROKEN, "broken").otherwise("other")
    return counted.select(*limits.columns, "board_count", kind.alias("kind"))


def index_next(index: DataFrame) -> DataFrame:
    """(dt, market): an index's return to its next day, as the market of a study; ``index`` (dt, close) is one series."""
    ahead = F.lead("close").over(Window.orderBy("dt"))
    return index.select("dt", (F.try_divide(ahead, F.col("close")) - 1).alias("market"))


#: Minutes after the open between which limits are compared; the midday break is not taken out.
CLOCK = (0.0, 15.0, 30.0, 60.0, 120.0, 210.0, 240.0, 999.0)


def time_effect(limits: DataFrame, value: str = "pct_chg", least: int = 100) -> DataFrame:
    """(lo, hi, n, mean, std) of ``value`` by the minutes after the open (``first_min``) at which a limit that held was
    reached; no row where there are fewer than ``least`` such days."""
    held = limits.filter((F.col("lim") == HELD) & F.col("first_min").isNotNull())
    enough = held.agg((F.count("*") >= least).alias("_enough"))
    return binned(held, "first_min", list(CLOCK), value).join(F.broadcast(enough), F.col("_enough")).drop("_enough")


def next_day_study(events: DataFrame, prices: DataFrame, least: int = 10, market: DataFrame | None = None) -> DataFrame:
    """Per kind: number, win rate, mean and median of the next row's return and its excess over the market's: ``market``
    (dt, market), an index say, or else the mean of all entities of the date."""
    w = Window.partitionBy("entity").orderBy("dt")
    nxt = prices.select("entity", "dt", (F.try_divide(F.lead("close").over(w), F.col("close")) - 1).alias("next"))
    market = nxt.groupBy("dt").agg(F.avg("next").alias("market")) if market is None else market
    rows = events.join(nxt, ["entity", "dt"], "left").join(market, "dt", "left").filter("next is not null")
    out = rows.groupBy("kind").agg(F.count("*").alias("n"), F.avg(F.when(F.col("next") > 0, 1.0).otherwise(0.0)).alias("win_rate"), F.avg("next").alias("mean"), F.percentile("next", 0.5).alias("median"), F.avg(F.col("next") - F.col("market")).alias("excess"))
    return out.filter(F.col("n") >= least)


def binned(df: DataFrame, column: str, edges: list[float], value: str) -> DataFrame:
    """(lo, hi, n, mean, std) of left-closed bins; empty bins stay."""
    spark = df.sparkSession
    bins = spark.createDataFrame(list(zip(range(len(edges) - 1), map(float, edges), map(float, edges[1:]), strict=False)), "bin int, lo double, hi double")
    place = F.when(F.lit(False), 0)
    for k, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        place = place.when((F.col(column) >= lo) & (F.col(column) < hi), k)
    found = df.select(place.alias("bin"), F.col(value).alias("v")).filter("bin is not null").groupBy("bin").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"))
    return bins.join(found, "bin", "left").select("lo", "hi", F.coalesce("n", F.lit(0)).alias("n"), "mean", "std")


def contagion(hits: DataFrame) -> DataFrame:
    """(size, days): on how many (date, industry) pairs so many entities were hit."""
    return hits.groupBy("dt", "industry").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("days"))


def next_returns(prices: DataFrame) -> DataFrame:
    """(entity, dt, next, market): each entity's return to its next row, and the mean of all entities' on that date."""
    nxt = prices.select("entity", "dt", (F.try_divide(F.lead("close").over(by_entity()), F.col("close")) - 1).alias("next"))
    return nxt.withColumn("market", F.avg("next").over(Window.partitionBy("dt")))
