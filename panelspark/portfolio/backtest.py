"""Long/short and quantile backtests, net asset values and their figures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_factor():
    return Window.partitionBy("factor").orderBy("dt")


def so_far():
    return by_factor().rowsBetween(Window.unboundedPreceding, 0)


def daily_returns(prices: DataFrame) -> DataFrame:
    """(entity, dt, ret): change of the close against the entity's row before."""
    before = F.lag("close").over(Window.partitionBy("entity").orderBy("dt"))
    return prices.select("entity", "dt", (F.try_divide("close", before) - 1).alias("ret"))


def numbered_dates(store: DataFrame) -> DataFrame:
    """(factor, dt, at): the dates of each factor, from 0; as many rows as there are dates."""
    return store.select("factor", "dt").distinct().select("factor", "dt", (F.row_number().over(by_factor()) - 1).alias("at"))


def long_short_positions(store: DataFrame, n_long: int, n_short: int, freq: int, max_weight: float = 1.0, dates: DataFrame | None = None) -> DataFrame:
    """(factor, period, dt, entity, side, weight) on every freq-th date; ties by entity, missing values take no part.

    ``dates``: what ``numbered_dates`` gave, where that is known already.
    """
    dates = numbered_dates(store) if dates is None else dates
    chosen = store.filter("value is not null").join(dates.filter(F.col("at") % freq == 0), ["factor", "dt"])
    day = Window.partitionBy("factor", "dt")
    ranked = chosen.select("*", F.row_number().over(day.orderBy(F.col("value").desc(), "entity")).alias("top"), F.row_number().over(day.orderBy("value", "entity")).alias("bottom"))
    sides = F.array(F.when(F.col("top") <= n_long, F.lit("long")), F.when(F.col("bottom") <= n_short, F.lit("short")))
    held = ranked.select("factor", F.floor(F.col("at") / freq).alias("period"), "dt", "entity", F.explode(F.filter(sides, lambda s: s.isNotNull())).alias("side"))
    weight = F.when(F.col("side") == "long", F.lit(min(1 / n_long, max_weight))).otherwise(F.lit(-min(1 / n_short, max_weight)))
    return held.withColumn("weight", weight)


def _period_dates(dates: DataFrame, freq: int, boundary: str) -> DataFrame:
    """(factor, dt, period): with ``inclusive`` boundaries a rebalance date belongs to the period it ends as well."""
    period = F.floor(F.col("at") / freq)
    first = F.col("at") % freq == 0
    if boundary == "inclusive":
        periods = F.when(first & (period > 0), F.array(period - 1, period)).otherwise(F.array(period))
    else:  # from the day after the rebalance to the next rebalance
        periods = F.when(first, F.when(period > 0, F.array(period - 1)).otherwise(F.array().cast("array<bigint>"))).otherwise(F.array(period))
    return dates.select("factor", "dt", F.explode(periods).alias("period"))


def long_short_returns(store: DataFrame, prices: DataFrame, n_long: int = 50, n_short: int = 50, freq: int = 20, commission: float = 0.0003, slippage: float = 0.001, boundary: str = "inclusive") -> DataFrame:
    """(factor, dt, long_ret, short_ret, ls_ret): mean returns of the legs, costs spread over the period; ls before costs.

    As the convention has it, an inclusive rebalance date counts in both its periods and the two are added.
    """
    dates = numbered_dates(store)
    held = long_short_positions(store, n_long, n_short, freq, dates=dates).select("factor", "period", "entity", "side")
    days = _period_dates(dates, freq, boundary)
    each = held.join(days, ["factor", "period"]).join(daily_returns(prices), ["entity", "dt"])
    legs = each.groupBy("factor", "dt", "period").agg(*(F.avg(F.when(F.col("side") == s, F.col("ret"))).alias(s) for s in ("long", "short")))
    total = legs.groupBy("factor", "dt").agg(F.sum("long").alias("long"), F.sum("short").alias("short"))
    cost = 2 * (commission + slippage) / freq
    return total.select("factor", "dt", (F.col("long") - cost).alias("long_ret"), (F.col("short") - cost).alias("short_ret"), (F.col("long") - F.col("short")).alias("ls_ret"))


def with_nav(returns: DataFrame, columns: tuple[str, ...] = ("long_ret", "short_ret", "ls_ret")) -> DataFrame:
    """Adds the compounded value of each return column, by factor."""
    return returns.select("*", *(F.product(1 + F.coalesce(c, F.lit(0.0))).over(so_far()).alias(c.replace("_ret", "_nav")) for c in columns))


def metrics(returns: DataFrame, column: str = "ls_ret", year: float = 252.0) -> DataFrame:
    """One row for each factor: total and annual return, volatility, Sharpe, drawdown with its date, Calmar, win rate, profit/loss.

    A day without a return counts as a day on which nothing was won; a value below zero has no annual return (NaN).
    """
    nav = returns.select("factor", "dt", F.col(column).alias("ret"), F.product(1 + F.col(column)).over(so_far()).alias("nav"))
    down = nav.select("*", (F.col("nav") / F.greatest(F.max("nav").over(so_far()), F.lit(1.0)) - 1).alias("dd"))
    out = down.groupBy("factor").agg(F.count("*").alias("n"), F.max_by("nav", F.when(F.col("nav").isNotNull(), F.col("dt"))).alias("last"), F.stddev_samp("ret").alias("s"), F.min("dd").alias("max_dd"), F.min_by("dt", F.struct(F.col("dd").isNull(), "dd", "dt")).alias("max_dd_date"), F.avg(F.when(F.col("ret") > 0, 1.0).otherwise(0.0)).alias("win_rate"), F.avg(F.when(F.col("ret") > 0, F.col("ret"))).alias("won"), F.avg(F.when(F.col("ret") < 0, F.col("ret"))).alias("lost"))
    annual = F.pow(F.col("last"), F.lit(year) / F.col("n")) - 1
    vol = F.col("s") * F.sqrt(F.lit(year))
    return out.select("factor", "n", (F.col("last") - 1).alias("total_return"), annual.alias("annual_return"), vol.alias("volatility"), F.try_divide(annual, vol).alias("sharpe"), "max_dd", "max_dd_date", F.try_divide(annual, -F.col("max_dd")).alias("calmar"), "win_rate", F.try_divide(F.col("won"), -F.col("lost")).alias("profit_loss"))


def group_returns(store: DataFrame, prices: DataFrame, n_groups: int = 10, freq: int = 20) -> DataFrame:
    """(factor, dt, group, ret): groups of equal size in descending order of value, the rest in the last; from the day after the rebalance."""
    day = Window.partitionBy("factor", "dt")
    dates = numbered_dates(store)
    chosen = store.filter("value is not null").join(dates.filter(F.col("at") % freq == 0), ["factor", "dt"])
    ranked = chosen.select("factor", F.floor(F.col("at") / freq).alias("period"), "entity", (F.row_number().over(day.orderBy(F.col("value").desc(), "entity")) - 1).alias("place"), F.floor(F.count("*").over(day) / n_groups).alias("size"))
    grouped = ranked.filter("size > 0").select("factor", "period", "entity", (F.least(F.floor(F.col("place") / F.col("size")), F.lit(n_groups - 1)) + 1).cast("int").alias("group"))
    each = grouped.join(_period_dates(dates, freq, "half_open"), ["factor", "period"]).join(daily_returns(prices), ["entity", "dt"])
    return each.groupBy("factor", "dt", "group").agg(F.avg("ret").alias("ret"))


def group_table(groups: DataFrame, n_groups: int = 10) -> DataFrame:
    """One row for each date: a column for each group and the spread of the first over the last."""
    wide = groups.groupBy("factor", "dt").agg(*(F.max(F.when(F.col("group") == g, F.col("ret"))).alias(f"group_{g}") for g in range(1, n_groups + 1)))
    return wide.withColumn("spread", F.col("group_1") - F.col(f"group_{n_groups}"))


def turnover(positions: DataFrame) -> DataFrame:
    """(factor, period, turnover): half the sum of the changes of weight against the period before."""
    now = positions.groupBy("factor", "period", "entity").agg(F.sum("weight").alias("w"))
    last = now.select("factor", (F.col("period") + 1).alias("period"), "entity", F.col("w").alias("before"))
    both = now.join(last, ["factor", "period", "entity"], "full")
    ends = now.groupBy("factor").agg(F.max("period").alias("end"))
    change = F.abs(F.coalesce("w", F.lit(0.0)) - F.coalesce("before", F.lit(0.0)))
    return both.join(ends, "factor").filter("period <= end").groupBy("factor", "period").agg((F.sum(change) / 2).alias("turnover"))


def composite(store: DataFrame, chosen: list[str], name: str = "composite") -> DataFrame:
    """A factor of its own: the sum of the z-scores by date of the chosen ones, a missing score counting 0."""
    day = Window.partitionBy("factor", "dt")
    z = F.try_divide(F.col("value") - F.avg("value").over(day), F.stddev_samp("value").over(day))
    scored = store.filter(F.col("factor").isin(chosen)).select("entity", "dt", z.alias("z"))
    return scored.groupBy("entity", "dt").agg(F.sum(F.coalesce("z", F.lit(0.0))).alias("value")).select(F.lit(name).alias("factor"), "entity", "dt", "value")


def trade_cost(value: Column, volume: Column, sigma: Column, gamma: float = 0.314, eta: float = 0.142, spread: float = 0.0005, commission: float = 0.0003) -> Column:
    """Cost of a trade as a share of its value: permanent and temporary impact, half the spread and the fee (5 at least)."""
    part = F.try_divide(value, volume)
    fee = F.try_divide(F.greatest(value * commission, F.lit(5.0)), value)
    full = sigma * gamma * F.sqrt(part) + sigma * eta * F.pow(part, F.lit(0.6)) + spread / 2 + fee
    return F.when((value > 0) & (volume > 0), full).otherwise(F.lit(2 * commission))


def rebalance_costs(target: DataFrame, current: DataFrame, prices: DataFrame, capital: float, least: float = 100.0) -> DataFrame:
    """(entity, change, cost): trades from current to target weights (entity, weight) at prices (entity, adv, sigma)."""
    both = target.select("entity", F.col("weight").alias("to")).join(current.select("entity", F.col("weight").alias("from")), "entity", "full").join(prices, "entity", "left")
    change = (F.coalesce("to", F.lit(0.0)) - F.coalesce("from", F.lit(0.0))) * capital
    traded = both.select("entity", change.alias("change"), F.coalesce("adv", F.lit(0.0)).alias("adv"), F.coalesce("sigma", F.lit(0.0)).alias("sigma")).filter(F.abs("change") >= least)
    return traded.select("entity", "change", (trade_cost(F.abs("change"), F.col("adv"), F.col("sigma")) * F.abs("change")).alias("cost"))


def run_strategy(generate: Callable[[DataFrame], DataFrame], bars: DataFrame) -> DataFrame:
    """(dt, ret): daily return of a user's weights. ``generate`` takes the bars and gives (entity, dt, weight), joined by key;
    a weight is held from the entity's next row on, and weights are scaled to a gross exposure of 1."""
    held = F.lag("weight").over(Window.partitionBy("entity").orderBy("dt"))
    own = generate(bars).select("entity", "dt", held.alias("held"))
    rows = daily_returns(bars).join(own, ["entity", "dt"]).filter("held is not null and ret is not null")
    return rows.groupBy("dt").agg(F.try_divide(F.sum(F.col("held") * F.col("ret")), F.sum(F.abs("held"))).alias("ret"))
