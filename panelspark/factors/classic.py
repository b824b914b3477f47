"""Classic families: valuation, momentum, volatility, quality and growth, attention, size and liquidity, market state."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.expr import Expr, apply, measure, over_series, windowed
from panelspark.factors.registry import register
from panelspark.operators import ts
from panelspark.operators.order import share_at_least

YEAR = math.sqrt(252.0)
close = measure("close")


def value() -> dict[str, Expr]:
    out = {n: 1 / ts.positive(measure(m)) for n, m in (("pe_ttm", "pe_ttm"), ("pb_lf", "pb"), ("ep_ttm", "pe_ttm"), ("sp_ttm", "ps_ttm"))}
    return out | {"div_yield": ts.positive(measure("dv_ttm"))}


def momentum() -> dict[str, Expr]:
    skip = lambda n: ts.ref(close, 1) / ts.ref(close, n + 1) - 1  # noqa: E731  the last row is left out
    out = {"ret_1m": skip(21), "ret_3m": skip(63), "ret_6m": skip(126), "ret_12m_1m": (1 + skip(252)) / (1 + skip(21)) - 1}
    return out | {"ret_1m_reverse": -ts.pct_change(close, 21), "max_ret_1m": ts.highest(ts.pct_change(close, 1), 21, 10)}


def volatility() -> dict[str, Expr]:
    r, market = ts.pct_change(close, 1), measure("market_ret")
    out = {"vol_1m": ts.std(r, 21, 10) * YEAR, "vol_3m": ts.std(r, 63, 30) * YEAR, "downside_vol_1m": ts.std(ts.when(r > 0, 0.0, r), 21, 10) * YEAR, "skew_1m": ts.skew_corrected(r, 21, 10)}
    own = apply("own", lambda a, b: F.when(b.isNotNull(), a), r, market)
    other = apply("other", lambda a, b: F.when(a.isNotNull(), b), r, market)
    out["beta_1y"] = ts.cov(own, other, 252, 60) / ts.not_zero(ts.std(other, 252, 60) ** 2)
    before = lambda: ts.rows(60, -1)  # noqa: E731  the sixty rows before this one

    def rest(a, b):
        var_m = F.var_samp(b).over(before())
        left = F.var_samp(a).over(before()) - F.try_divide(F.pow(F.covar_samp(a, b).over(before()), F.lit(2.0)), var_m)
        return F.when((F.count(a).over(before()) == 60) & (var_m != 0), F.sqrt(F.greatest(left, F.lit(0.0))) * YEAR)

    return out | {"idiosyncratic_vol": windowed("idiosyncratic", rest, own, other)}


def reports() -> dict[str, Expr]:
    """Of quarterly reports; a missing one is filled from the last four."""
    filled = {"roe_ttm": "roe", "roa_ttm": "roa", "gross_margin": "grossprofit_margin", "net_margin": "netprofit_margin", "revenue_growth_yoy": "or_yoy", "earnings_growth_yoy": "profit_dedt", "asset_growth_yoy": "or_yoy"}
    out = {n: ts.fill_forward(measure(m), 4) for n, m in filled.items()}
    roe = ts.fill_forward(measure("roe"), 20)
    return out | {"debt_to_assets": -ts.fill_forward(measure("debt_to_assets"), 4), "earnings_stability": -(ts.std(roe, 20, 8) / ts.not_zero(ts.absolute(ts.mean(roe, 20, 8))))}


def liquidity() -> dict[str, Expr]:
    cap, turnover = measure("total_mv"), measure("turnover_rate")
    traded = cap * turnover / 100
    thin = ts.absolute(ts.pct_change(close, 1)) / ts.larger(traded, 1e-8)
    average = ts.mean(turnover, 21, 10)
    return {"ln_market_cap": ts.log(cap), "turnover_1m": average, "turnover_cv": ts.std(turnover, 21, 10) / ts.not_zero(average), "amihud_illiq": ts.mean(thin, 21, 10), "dollar_volume_1m": ts.log(ts.larger(ts.mean(traded, 21, 10), 1.0))}


def attention() -> dict[str, Expr]:
    """Of a series ``value`` of one source."""
    heat = ts.log(ts.larger(measure("value"), 1.0))
    return {"attention": heat, "attention_delta_1w": ts.delta(heat, 5)}


def market_state() -> dict[str, Expr]:
    """Of market-level series: share of the last 1,261 values that are at least today's, and momentum."""
    x = measure("value")
    share = over_series(("share at least", 1261), lambda v: share_at_least(v, 1261, 252), x)
    return {"market_pe_pct": share, "bdi_momentum": ts.pct_change(x, 63), "margin_balance_ratio": ts.pct_change(x, 21), "series_level": x}


for _category, _family in (("value", value), ("classic_momentum", momentum), ("volatility", volatility), ("reports", reports), ("liquidity", liquidity), ("attention", attention), ("market_state", market_state)):
    register(_category, _family())


def money_flow() -> dict[str, Expr]:
    """Net flow of large orders over five rows, as a share of the free-float value (1e10 where that is missing)."""
    return {"moneyflow_pct_5d": ts.total(measure("main_net"), 5) / ts.or_else(measure("float_mv"), 1e10)}


#: Sources of the attention factors by name.
HEAT_SOURCES = {"xq_discussion": "xq_hot_tweet", "xq_deal_heat": "xq_hot_deal"}
LEVEL_SOURCES = {"weibo_sentiment": "weibo_report"}


def heat_of_sources(heat: DataFrame, sources: dict[str, str] = HEAT_SOURCES) -> DataFrame:
    """(factor, entity, dt, value): log heat of each named source of (source, entity, dt, value)."""
    name = F.lit(None).cast("string")
    for factor, source in sources.items():
        name = F.when(F.col("source") == source, factor).otherwise(name)
    return heat.filter(F.col("source").isin(list(sources.values()))).select(name.alias("factor"), "entity", "dt", F.log(F.greatest("value", F.lit(1.0))).alias("value"))


def level_of_sources(series: DataFrame, sources: dict[str, str] = LEVEL_SOURCES) -> DataFrame:
    """(factor, entity, dt, value): the value itself of each named source."""
    out = None
    for factor, source in sources.items():
        one = series.filter(F.col("source") == source).select(F.lit(factor).alias("factor"), "entity", "dt", "value")
        out = one if out is None else out.unionByName(one)
    return out


def yield_spread(own: DataFrame, other: DataFrame) -> DataFrame:
    """(dt, value): one yield less the other on the dates that both have (cn_us_spread_10y)."""
    return own.join(other.select("dt", F.col("value").alias("other")), "dt").select("dt", (F.col("value") - F.col("other")).alias("value"))


register("money_flow", money_flow())
