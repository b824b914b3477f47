"""Market sentiment: component series, scores and the composite index."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.expr import Expr, evaluate, measure
from panelspark.operators import ts

LABELS = ((20, "extreme fear"), (40, "fear"), (60, "neutral"), (80, "greed"))
HIGHEST = "extreme greed"


def pct_rank_score(x: Expr, n: int = 252, least: int = 60) -> Expr:
    """Share (0 to 100) of the average rank of today's value in the window."""
    return ts.pct_rank_rolling(x, n, least)


def rolling_z(x: Expr, n: int = 252, least: int = 20) -> Expr:
    return (x - ts.mean(x, n, least)) / ts.not_zero(ts.std(x, n, least))


def z_score(x: Expr, n: int = 252, least: int = 20, bound: float = 3.0) -> Expr:
    """Rolling z, clipped, on a scale from 0 to 100."""
    return (ts.smaller(ts.larger(rolling_z(x, n, least), -bound), bound) + bound) / (2 * bound) * 100


def label(score: Column) -> Column:
    """Word for a score; a missing one gets the highest label, as comparisons with it fail."""
    out = None
    for bound, word in LABELS:
        out = F.when(score < bound, word) if out is None else out.when(score < bound, word)
    return out.otherwise(HIGHEST)


def price_momentum(n: int = 250, least: int = 60) -> Expr:
    close = measure("close")
    return (close - ts.mean(close, n, least)) / ts.mean(close, n, least) * 100


def realised_volatility(n: int = 30, least: int = 10) -> Expr:
    return ts.std(ts.pct_change(measure("close"), 1), n, least) * math.sqrt(252)


def breadth(bars: DataFrame, n: int = 20, least: int = 5) -> DataFrame:
    """(dt, value): share of entities above their own mean, in per cent; one without a mean is not above."""
    close = measure("close")
    above = evaluate(bars, {"above": ts.when(close > ts.mean(close, n, least), 1.0, 0.0)})
    return above.groupBy("dt").agg((F.avg("above") * 100).alias("value"))


def side_ratio(events: DataFrame, up: str, down: str) -> DataFrame:
    """(dt, value): events of the one side over those of both, in per cent; dates without either have no row."""
    n = lambda s: F.sum(F.when(F.col("side") == s, 1).otherwise(0))
    return events.filter(F.col("side").isin(up, down)).groupBy("dt").agg((n(up) / (n(up) + n(down)) * 100).alias("value"))


def weighted_turnover(rows: DataFrame, rate: str, weight: str) -> DataFrame:
    """(dt, value): mean of the rate by weight, over rows where both are there and the weight is positive."""
    use = rows.filter(F.col(rate).isNotNull() & (F.col(weight) > 0))
    return use.groupBy("dt").agg(F.try_divide(F.sum(F.col(rate) * F.col(weight)), F.sum(weight)).alias("value"))


def scores(components: DataFrame, inverted: tuple[str, ...] = ("volatility",), n: int = 252, least: int = 60) -> DataFrame:
    """(name, dt, score) of long components (name, dt, value): rolling share of the rank, turned round for inverted ones."""
    x = measure("value")
    made = evaluate(components.withColumnRenamed("name", "entity"), {"score": pct_rank_score(x, n, least)})
    score = F.when(F.col("entity").isin(*inverted), 100 - F.col("score")).otherwise(F.col("score"))
    return made.select(F.col("entity").alias("name"), "dt", F.when(score.isNotNull(), F.greatest(F.least(score, F.lit(100.0)), F.lit(0.0))).alias("score"))


def composite_index(scored: DataFrame, least: int = 4, days: DataFrame | None = None) -> DataFrame:
    """(dt, n_available, index, label): mean of the scores of a date, missing under ``least`` of them; only on ``days`` if given.

    The scores stay long: a union of series and one aggregation by date do what full outer joins would.
    """
    out = scored.groupBy("dt").agg(F.count("score").alias("n_available"), F.avg("score").alias("mean"))
    if days is not None:
        out = out.join(days.select("dt").distinct(), "dt", "left_semi")
    index = F.when(F.col("n_available") >= least, F.col("mean"))
    return out.select("dt", "n_available", index.alias("index"), label(index).alias("label"))


def market_amount(bars: DataFrame, codes: list) -> DataFrame:
    """(dt, value): amounts of the given indices together."""
    return bars.filter(F.col("entity").isin(codes)).groupBy("dt").agg(F.sum("amount").alias("value"))


def margin_share(bought: DataFrame, bars: DataFrame) -> DataFrame:
    """(dt, value): sum of margin purchases (``bought``) over the sum of amounts, in per cent, on dates that both have."""
    a, b = bought.groupBy("dt").agg(F.sum("bought").alias("bought")), bars.groupBy("dt").agg(F.sum("amount").alias("amount"))
    return a.join(b, "dt").select("dt", (F.try_divide("bought", "amount") * 100).alias("value"))


def northbound_score(n: int = 20, least: int = 5) -> Expr:
    """Of a cumulative series ``value``: rolling sum of its daily changes, as a clipped rolling z from 0 to 100."""
    return z_score(ts.total(ts.delta(measure("value"), 1), n, least))
