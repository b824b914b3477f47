"""Analyst forecasts by industry, and composite scores of sectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_snapshot(forecasts: DataFrame, at: str = "snapshot_date") -> DataFrame:
    """The rows of the last snapshot; its date is one row, broadcast."""
    return forecasts.join(F.broadcast(forecasts.agg(F.max(at).alias(at))), at)


def analyst_factors(forecasts: DataFrame) -> DataFrame:
    """Per industry: mean share of buy ratings, median growth of expected earnings, median spread of targets, coverage."""
    share = (F.col("rating_buy_num") + F.col("rating_add_num")) / F.greatest("rating_org_num", F.lit(1))
    growth = (F.col("eps2") - F.col("eps1")) / F.greatest(F.abs("eps1"), F.lit(0.01))
    spread = F.try_divide("aim_price_max", "aim_price_min")
    return forecasts.groupBy("industry").agg(F.avg(share).alias("buy_share"), F.percentile(growth, 0.5).alias("growth"), F.percentile(spread, 0.5).alias("target_spread"), F.sum("rating_org_num").alias("coverage"))


def sector_scores(factors: DataFrame, weights: dict[str, float], extra: DataFrame | None = None, extra_weights: dict[str, float] | None = None, floor: float = 1e-8) -> DataFrame:
    """(entity, dt, score): weighted z-scores by date over rows with all factors; on the last date the z-scores of ``extra``
    (one row for each entity) are added by their weights."""
    day = Window.partitionBy("dt")
    rows = factors.dropna(subset=list(weights))
    z = sum((F.lit(w) * (F.col(c) - F.avg(c).over(day)) / F.greatest(F.stddev_samp(c).over(day), F.lit(floor)) for c, w in weights.items()), F.lit(0.0))
    scored = rows.select("entity", "dt", z.alias("score"))
    if extra is None:
        return scored
    alone = Window.partitionBy()  # over one row for each entity of a reference table
    bonus = sum((F.lit(w) * F.coalesce((F.col(c) - F.avg(c).over(alone)) / F.greatest(F.stddev_samp(c).over(alone), F.lit(floor)), F.lit(0.0)) for c, w in (extra_weights or {}).items()), F.lit(0.0))
    last = scored.agg(F.max("dt").alias("dt"), F.lit(True).alias("is_last"))
    both = scored.join(extra.select("entity", bonus.alias("bonus")), "entity", "left").join(F.broadcast(last), "dt", "left")
    return both.select("entity", "dt", (F.col("score") + F.when(F.col("is_last"), F.coalesce("bonus", F.lit(0.0))).otherwise(0.0)).alias("score"))
