"""Sector rotation: momentum, crowding, periodic top-n backtest and correlations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.expr import evaluate, measure
from panelspark.operators import cs, ts


def momentum(bars: DataFrame, lookback: int = 20) -> DataFrame:
    return evaluate(bars, {"momentum": ts.pct_change(measure("close"), lookback)})


def crowding(bars: DataFrame, n: int = 20) -> DataFrame:
    """(entity, dt, crowding): mean of two ranks of the date: share of the amount, and volatility."""
    share = ts.as_expr(measure("amount")) / measure("total")
    with_total = bars.withColumn("total", F.sum("amount").over(Window.partitionBy("dt")))
    vol = ts.std(ts.pct_change(measure("close"), 1), n, n)
    return evaluate(with_total, {"crowding": (cs.rank_pct(share) + cs.rank_pct(vol)) / 2})


def rotation_score(bars: DataFrame, lookback: int = 20) -> DataFrame:
    """(entity, dt, score): rank of the momentum plus one less the crowding."""
    both = momentum(bars, lookback).join(crowding(bars, lookback), ["entity", "dt"])
    return evaluate(both, {"score": cs.rank_pct(measure("momentum")) + (1 - measure("crowding"))})


def period_of(dt: Column, freq: str) -> Column:
    """Number of an ISO week (year * 100 + week) or of a month (year * 100 + month)."""
    return F.extract(F.lit("YEAROFWEEK"), dt) * 100 + F.weekofyear(dt) if freq == "W" else F.year(dt) * 100 + F.month(dt)


def rotation_backtest(signal: DataFrame, bars: DataFrame, top_n: int = 5, freq: str = "M") -> DataFrame:
    """(period, n, ret): the top n of each period's last date, held equally over the next period; mean daily returns compounded.

    ``signal`` is (entity, dt, score). Periods that offer fewer than n are left out; ties by entity.
    """
    ret = evaluate(bars, {"ret": ts.pct_change(measure("close"), 1)})
    dates = bars.select("dt").distinct().withColumn("period", period_of(F.col("dt"), freq))
    # Periods are few: a window over them without a partition key is small.
    periods = dates.groupBy("period").agg(F.max("dt").alias("last")).withColumn("next", F.lead("period").over(Window.orderBy("period")))
    last = signal.filter("score is not null").join(F.broadcast(periods), F.col("dt") == F.col("last")).filter("next is not null")
    day = Window.partitionBy("dt")
    ranked = last.select("entity", "next", F.row_number().over(day.orderBy(F.col("score").desc(), "entity")).alias("place"), F.count("*").over(day).alias("n"))
    held = ranked.filter((F.col("place") <= top_n) & (F.col("n") >= top_n)).select("entity", F.col("next").alias("period"))
    days = ret.join(F.broadcast(dates), "dt").join(held, ["entity", "period"]).groupBy("period", "dt").agg(F.avg("ret").alias("r"))
    return days.groupBy("period").agg(F.count("r").alias("n"), (F.product(1 + F.coalesce("r", F.lit(0.0))) - 1).alias("ret"))


def sector_correlation(bars: DataFrame, days: int = 365) -> DataFrame:
    """(a, b, n, corr) of daily returns of every two sectors over the last days, both ways round.

    Sectors are few (tens); dates join them, so the rows are dates times pairs of sectors.
    """
    ret = evaluate(bars, {"ret": ts.pct_change(measure("close"), 1)}).filter("ret is not null")
    last = ret.agg(F.date_sub(F.max("dt"), days).alias("since"))
    recent = ret.join(F.broadcast(last), F.col("dt") > F.col("since")).drop("since")
    x, y = (recent.select("dt", F.col("entity").alias(n), F.col("ret").alias(f"r{n}")) for n in ("a", "b"))
    half = x.join(y, "dt").filter("a < b").groupBy("a", "b").agg(F.count("*").alias("n"), F.corr("ra", "rb").alias("corr"))
    return half.unionByName(half.select(F.col("b").alias("a"), F.col("a").alias("b"), "n", "corr"))


def period_stats(periods: DataFrame, per_year: float = 52.0) -> DataFrame:
    """One row: cumulative and annual return, win rate and the deepest drawdown of a few periods."""
    w = Window.orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    nav = periods.select("period", "ret", F.product(1 + F.col("ret")).over(w).alias("nav"))
    dd = nav.select("*", (F.col("nav") / F.max("nav").over(w) - 1).alias("dd"))
    out = dd.agg(F.count("*").alias("n"), F.max_by("nav", "period").alias("last"), F.avg(F.when(F.col("ret") > 0, 1.0).otherwise(0.0)).alias("win_rate"), F.min("dd").alias("max_dd"))
    return out.select("n", (F.col("last") - 1).alias("total"), (F.pow(F.greatest("last", F.lit(0.0)), F.lit(per_year) / F.col("n")) - 1).alias("annual"), "win_rate", "max_dd")


def extremes(scores: DataFrame, n: int = 5) -> DataFrame:
    """(side, place, entity, score): the n best and the n worst of the last date."""
    last = scores.filter("score is not null").agg(F.max("dt").alias("dt"))
    now = scores.filter("score is not null").join(F.broadcast(last), "dt").select("entity", "score")
    side = lambda name, *order: now.orderBy(*order).limit(n).select(F.lit(name).alias("side"), "entity", "score")
    both = side("top", F.col("score").desc(), "entity").unionByName(side("bottom", "score", "entity"))
    best = Window.partitionBy("side").orderBy(F.when(F.col("side") == "top", -F.col("score")).otherwise(F.col("score")), "entity")
    return both.select("side", F.row_number().over(best).alias("place"), "entity", "score")
