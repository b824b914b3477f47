"""Tear sheets and information coefficients."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.ranks import pooled_rank

from panelspark.portfolio.backtest import so_far


def monthly_returns(returns: DataFrame, column: str = "ls_ret") -> DataFrame:
    """(factor, month, ret): compounded by calendar month."""
    return returns.groupBy("factor", F.date_format("dt", "yyyy-MM").alias("month")).agg((F.product(1 + F.col(column)) - 1).alias("ret"))


def tear_sheet(returns: DataFrame, column: str = "ls_ret", year: float = 252.0) -> DataFrame:
    """One row for each factor: annual figures, drawdown and its longest run, tail risk, Sharpe, Sortino, shape of the returns.

    A day without a return counts as a day, as in ``metrics``.
    """
    nav = returns.select("factor", "dt", F.col(column).alias("ret"), F.product(1 + F.col(column)).over(so_far()).alias("nav"))
    down = nav.select("*", (F.col("nav") / F.max("nav").over(so_far()) - 1).alias("dd"))
    # Days under water form islands: a day at its peak starts a new one.
    island = down.select("*", F.sum(F.when(F.col("dd") >= 0, 1).otherwise(0)).over(so_far()).alias("island"))
    runs = island.filter("dd < 0").groupBy("factor", "island").agg(F.count("*").alias("run")).groupBy("factor").agg(F.max("run").alias("dd_days"))
    tail = nav.groupBy("factor").agg(F.percentile("ret", 0.05).alias("var_95"))
    figures = down.join(tail, "factor").groupBy("factor").agg(
        F.count("*").alias("n"),
        F.max_by("nav", F.when(F.col("nav").isNotNull(), F.col("dt"))).alias("last"),
        F.stddev_samp("ret").alias("s"),
        F.stddev_samp(F.when(F.col("ret") < 0, F.col("ret"))).alias("s_down"),
        F.avg("ret").alias("mean"),
        F.stddev_pop("ret").alias("s_pop"),
        F.min("dd").alias("max_dd"),
        F.first("var_95").alias("var_95"),
        F.avg(F.when(F.col("ret") <= F.col("var_95"), F.col("ret"))).alias("cvar_95"),
        F.skewness("ret").alias("skew"),
        F.kurtosis("ret").alias("kurt"),
        F.avg(F.when(F.col("ret") > 0, 1.0).otherwise(0.0)).alias("positive_days"),
    )
    annual = F.pow(F.col("last"), F.lit(year) / F.col("n")) - 1
    root = F.sqrt(F.lit(year))
    out = figures.join(runs, "factor", "left")
    return out.select("factor", annual.alias("annual_return"), (F.col("s") * root).alias("annual_vol"), F.try_divide(annual, F.col("s") * root).alias("sharpe"), F.try_divide(annual, F.col("s_down") * root).alias("sortino"), "max_dd", F.coalesce("dd_days", F.lit(0)).cast("long").alias("dd_days"), F.try_divide(annual, -F.col("max_dd")).alias("calmar"), "var_95", "cvar_95", (F.try_divide(F.col("mean"), F.col("s_pop")) * root).alias("ir"), "skew", "kurt", "positive_days")


def forward_returns(prices: DataFrame, days: int) -> DataFrame:
    """(entity, dt, fwd): return over the entity's next rows."""
    ahead = F.lead("close", days).over(Window.partitionBy("entity").orderBy("dt"))
    return prices.select("entity", "dt", (F.try_divide(ahead, F.col("close")) - 1).alias("fwd"))


def rank_ic(store: DataFrame, prices: DataFrame, days: int = 5, least: int = 30) -> DataFrame:
    """(factor, dt, n, ic): correlation of the ranks of value and forward return on dates with enough complete pairs; ties by entity."""
    both = store.join(forward_returns(prices, days), ["entity", "dt"]).filter("value is not null and fwd is not null")
    day = Window.partitionBy("factor", "dt")
    ranks = both.select("factor", "dt", F.row_number().over(day.orderBy("value", "entity")).alias("x"), F.row_number().over(day.orderBy("fwd", "entity")).alias("y"))
    # Both ranks run from 1 to n, so the correlation follows from the sum of squared differences.
    out = ranks.groupBy("factor", "dt").agg(F.count("*").alias("n"), F.sum(F.pow((F.col("x") - F.col("y")).cast("double"), F.lit(2.0))).alias("d"))
    n = F.col("n").cast("double")
    return out.filter(F.col("n") >= least).select("factor", "dt", "n", (1 - 6 * F.col("d") / (n * (n * n - 1))).alias("ic"))


def ic_summary(ic: DataFrame) -> DataFrame:
    return ic.groupBy("factor").agg(F.count("*").alias("dates"), F.avg("ic").alias("ic_mean"), F.stddev_samp("ic").alias("ic_std"), F.avg(F.when(F.col("ic") > 0, 1.0).otherwise(0.0)).alias("positive")).withColumn("icir", F.try_divide("ic_mean", "ic_std"))


def ic_decay(store: DataFrame, prices: DataFrame, lags: int = 20, least: int = 30) -> DataFrame:
    """(factor, lag, n, ic): correlation of the ranks over all pooled rows of value and return to each lag; 0 for few pairs.

    A column's ranks count all its values (average of ties), also those whose partner is missing.
    """
    values = pooled_rank(store.filter("value is not null").join(prices.select("entity", "dt"), ["entity", "dt"]), ["factor"], "value", "x")
    ahead = _ahead(prices, Window.partitionBy("entity").orderBy("dt"), lags)
    both = values.select("factor", "entity", "dt", "x").join(ahead.filter("fwd is not null"), ["entity", "dt"])
    ranked = pooled_rank(both, ["factor", "lag"], "fwd", "y")
    out = ranked.groupBy("factor", "lag").agg(F.count("*").alias("n"), F.corr("x", "y").alias("ic"))
    return out.select("factor", "lag", "n", F.when(F.col("n") >= least, F.col("ic")).otherwise(0.0).alias("ic"))


def _ahead(prices: DataFrame, w, lags: int) -> DataFrame:
    wide = prices.select("entity", "dt", *((F.try_divide(F.lead("close", k).over(w), F.col("close")) - 1).alias(f"f{k}") for k in range(1, lags + 1)))
    return wide.unpivot(["entity", "dt"], [f"f{k}" for k in range(1, lags + 1)], "name", "fwd").select("entity", "dt", F.substring("name", 2, 3).cast("int").alias("lag"), "fwd")


def capacity(metrics: DataFrame, capitals: list[float], year: float = 252.0) -> DataFrame:
    """Annual return and Sharpe of each factor at each level of capital, after an impact of sqrt(capital / 1000) * 0.0005."""
    impact = F.sqrt(F.col("capital") / 1000) * 0.0005
    levels = metrics.select("*", F.explode(F.array(*map(F.lit, capitals))).alias("capital"))
    adjusted = F.col("annual_return") - impact * 100 * year
    return levels.select("factor", "capital", impact.alias("impact"), adjusted.alias("annual_return"), (F.try_divide(adjusted, F.col("annual_return")) * F.col("sharpe")).alias("sharpe"))

