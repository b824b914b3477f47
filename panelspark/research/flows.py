"""Studies of a daily flow series against later returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.expr import evaluate, measure
from panelspark.operators import ts
from panelspark.research.sentiment import rolling_z

HORIZONS = (1, 5, 10, 20)


def study_frame(flow: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Adds forward returns of ``close`` over each horizon to (entity, dt, flow, close)."""
    w = Window.partitionBy("entity").orderBy("dt")
    return flow.select("*", *((F.try_divide(F.lead("close", k).over(w), F.col("close")) - 1).alias(f"fwd_{k}") for k in horizons))


def flow_ic(frame: DataFrame, horizons: tuple[int, ...] = HORIZONS, window: int = 60) -> DataFrame:
    """(horizon, corr, rolling_mean, rolling_std, ir, positive): correlation of the flow with each forward return."""
    made = evaluate(frame, {f"c{k}": ts.corr(measure("flow"), measure(f"fwd_{k}"), window, window) for k in horizons})
    both = frame.join(made, ["entity", "dt"])
    cols = [F.struct(F.lit(k).alias("horizon"), F.col("flow").alias("flow"), F.col(f"fwd_{k}").alias("fwd"), F.col(f"c{k}").alias("c")) for k in horizons]
    long = both.select(F.explode(F.array(*cols)).alias("r")).select("r.*")
    out = long.groupBy("horizon").agg(F.corr("flow", "fwd").alias("corr"), F.avg("c").alias("rolling_mean"), F.stddev_samp("c").alias("rolling_std"), F.avg(F.when(F.col("c").isNotNull(), F.when(F.col("c") > 0, 1.0).otherwise(0.0))).alias("positive"))
    return out.withColumn("ir", F.try_divide("rolling_mean", "rolling_std"))


def resonance(frame: DataFrame, columns: list[str], window: int = 60, bound: float = 1.0) -> DataFrame:
    """(entity, dt, signal): 1 where the rolling z of all columns is above the bound, -1 where all are below its negative."""
    z = evaluate(frame, {c: rolling_z(measure(c), window, window) for c in columns})
    up = down = F.lit(True)
    for c in columns:
        up, down = up & F.coalesce(F.col(c) > bound, F.lit(False)), down & F.coalesce(F.col(c) < -bound, F.lit(False))
    return z.select("entity", "dt", F.when(up, 1).when(down, -1).otherwise(0).alias("signal"))


def smart_money_frame(net: DataFrame, index: DataFrame, margin: DataFrame, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """One series (dt): daily flow out of a cumulative ``net``, its share of the index's amount, the margin purchases' share and
    forward returns. All three inputs are (dt, ..): net (total), index (close, amount), margin (bought); dates must be in all."""
    w = Window.partitionBy("entity").orderBy("dt")
    both = net.join(index, "dt").join(margin, "dt").select(F.lit(0).alias("entity"), "*")
    flow = both.withColumn("flow", F.col("total") - F.lag("total").over(w))
    out = flow.withColumn("flow_pct", F.try_divide("flow", "amount") * 100).withColumn("margin_pct", F.try_divide("bought", "amount") * 100)
    return study_frame(out.select("entity", "dt", "flow", "flow_pct", "margin_pct", "close"), horizons)


#: Left-closed bins of signed streaks.
STREAK_EDGES = [-99, -10, -5, -3, -1, 1, 3, 5, 10, 99]


def streak_analysis(frame: DataFrame, horizons: tuple[int, ...] = HORIZONS, per_year: float = 252.0) -> DataFrame:
    """(lo, hi, horizon, n, mean, std, annual, ir) of the forward returns by bins of ``streak``; empty bins stay out."""
    lo = hi = F.lit(None).cast("int")
    for a, b in zip(STREAK_EDGES, STREAK_EDGES[1:], strict=False):
        inside = (F.col("streak") >= a) & (F.col("streak") < b)
        lo, hi = F.when(inside, a).otherwise(lo), F.when(inside, b).otherwise(hi)
    each = frame.select(lo.alias("lo"), hi.alias("hi"), F.explode(F.array(*(F.struct(F.lit(k).alias("horizon"), F.col(f"fwd_{k}").alias("fwd")) for k in horizons))).alias("r"))
    out = each.filter("lo is not null and r.fwd is not null").groupBy("lo", "hi", "r.horizon").agg(F.count("*").alias("n"), F.avg("r.fwd").alias("mean"), F.stddev_samp("r.fwd").alias("std"))
    return out.withColumn("annual", F.col("mean") * per_year / F.col("horizon")).withColumn("ir", F.try_divide("mean", "std"))


def signal_summary(frame: DataFrame, horizons: tuple[int, ...] = (5, 20)) -> DataFrame:
    """(signal, n, mean forward returns) of ``frame`` (signal, fwd_..), for every value of the signal."""
    return frame.groupBy("signal").agg(F.count("*").alias("n"), *(F.avg(f"fwd_{k}").alias(f"mean_{k}") for k in horizons))
