"""Price, volume, rolling, technical, momentum, drawdown and correlation factors, each one line of the operator library."""

from __future__ import annotations

from panelspark.expr import Expr, measure
from panelspark.factors.registry import register
from panelspark.operators import ts

open_, high, low, close, volume, amount = map(measure, ("open", "high", "low", "close", "volume", "amount"))


def price() -> dict[str, Expr]:
    out = {f"ret_{n}d": ts.ref(close, n) / close - 1 for n in (1, 3, 5, 7, 10, 15, 20, 30, 60, 90, 120, 180, 240)}
    out |= {f"amp_{n}d": (ts.highest(high, n) - ts.lowest(low, n)) / ts.ref(close, n) for n in (3, 5, 7, 10, 20, 60, 90)}
    out |= {f"high_low_spread_{n}d": ts.highest(high, n) / ts.lowest(low, n) - 1 for n in (5, 10, 20)}
    return out | {"overnight_ret": open_ / ts.ref(close, 1) - 1, "intraday_ret": close / open_ - 1}


def volumes() -> dict[str, Expr]:
    out = {f"{kind}_change_{n}d": x / ts.ref(x, n) for kind, x in (("vol", volume), ("amount", amount)) for n in (3, 5, 10, 20)}
    for kind, x, pairs in (("vol", volume, ((5, 20), (10, 60), (20, 60), (60, 120))), ("amount", amount, ((5, 20), (10, 20), (20, 60)))):
        out |= {f"{kind}_mean_{n}d": ts.mean(x, n) / ts.mean(x, m) for n, m in pairs}
    return out | {"vol_std_20d": ts.std(volume, 20) / ts.mean(volume, 20), "vol_max_20d": volume / ts.highest(volume, 20)}


def rolling() -> dict[str, Expr]:
    out = {f"close_mean_{n}d": ts.mean(close, n) / close - 1 for n in (3, 5, 7, 10, 20, 30, 60, 90, 120)}
    out |= {f"close_std_{n}d": ts.std(close, n) / ts.mean(close, n) for n in (5, 10, 20, 30, 60, 90, 120)}
    out |= {f"close_{kind}_{n}d": close / f(close, n) for kind, f in (("max", ts.highest), ("min", ts.lowest)) for n in (5, 10, 20, 60)}
    out |= {"close_skew_20d": ts.skew_own(close, 20), "close_kurt_20d": ts.kurt_own(close, 20), "vol_skew_20d": ts.skew_own(volume, 20)}
    out |= {f"vol_std_{n}d": ts.std(volume, n) / ts.mean(volume, n) for n in (5, 10)}
    return out | {f"{kind}_mean_{n}d": ts.mean(x, n) / close for kind, x in (("high", high), ("low", low)) for n in (5, 10)}


def technical() -> dict[str, Expr]:
    out = {f"rsi_{n}": ts.rsi(close, n) for n in (6, 9, 14, 24, 48)}
    return out | {f"ema_{n}": ts.ewm(close, n) / close for n in (12, 26)} | {"ema_12_26": ts.ewm(close, 12) / ts.ewm(close, 26)}


def momentum() -> dict[str, Expr]:
    out = {f"mom_{n}d": ts.delta(close, n) for n in (1, 3, 5, 7, 10, 15, 20, 60, 90, 120)}
    out |= {f"ma_dev_{n}d": (close - ts.mean(close, n)) / ts.mean(close, n) for n in (5, 10, 20, 60)}
    out |= {f"ma_dev_{n}_{m}": ts.mean(close, n) / ts.mean(close, m) - 1 for n, m in ((5, 20), (10, 60))}
    return out | {f"chg_{n}d": ts.pct_change(close, n) for n in (5, 10, 20, 30, 60, 90)}


def drawdown() -> dict[str, Expr]:
    out = {f"dd_{n}d": close / ts.highest(close, n) - 1 for n in (5, 10, 20, 60, 120)}
    return out | {f"atr_{n}": ts.mean(high - low, n) / close for n in (5, 7, 14)}


def correlation() -> dict[str, Expr]:
    return {"corr_close_vol_20": ts.corr_own(close, volume, 20), "corr_close_amount_20": ts.corr_own(close, amount, 20), "corr_high_low_20": ts.corr_own(high, low, 20)}


def oscillators() -> dict[str, Expr]:
    """KDJ, on-balance volume and range volatilities."""
    floor, top = ts.lowest(low, 9, 1), ts.highest(high, 9, 1)
    rsv = (close - floor) / ts.or_else(ts.not_zero(top - floor), 1.0) * 100
    k = ts.ewm(rsv, 3, 1)
    d = ts.ewm(k, 3, 1)
    obv = ts.cumulative(ts.when(ts.delta(close, 1) > 0, volume, ts.when(ts.delta(close, 1) < 0, -volume, 0.0)))
    parkinson = ts.sqrt(ts.total(ts.log(high / low) ** 2, 20, 5) / (4 * 1.3863))
    overnight, inside = ts.log(open_ / ts.ref(close, 1)), ts.log(close / open_)
    k_yz = 0.34 / (1.34 + 21 / 19)
    yang_zhang = ts.sqrt(ts.std(overnight, 20, 5) ** 2 + ts.std(inside, 20, 5) ** 2 * k_yz)
    return {"kdj_k": k, "kdj_d": d, "kdj_j": 3 * k - 2 * d, "obv": obv, "parkinson_vol_20d": parkinson, "yang_zhang_vol_20d": yang_zhang}


for _category, _family in (("price", price), ("volume", volumes), ("rolling", rolling), ("tech", technical), ("momentum", momentum), ("leverage", drawdown), ("correlation", correlation), ("oscillator", oscillators)):
    register(_category, _family())
