"""The 158 factors of bars: 9 of the candle, 4 of price, and 29 for each of five windows. Windows need max(5, w // 2) rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.expr import Expr, apply, as_expr, measure, windowed
from panelspark.factors.registry import register
from panelspark.operators import cs, ts

WINDOWS = (5, 10, 20, 30, 60)
EPS = 1e-12

open_, high, low, close, volume, vwap = map(measure, ("open", "high", "low", "close", "volume", "vwap"))


def candle() -> dict[str, Expr]:
    base, span = ts.not_zero(open_), high - low + EPS
    body, up, down, shift = close - open_, high - ts.larger(open_, close), ts.smaller(open_, close) - low, 2 * close - high - low
    over_open = {"KMID": body, "KLEN": high - low, "KUP": up, "KLOW": down, "KSFT": shift}
    over_span = {"KMID2": body, "KUP2": up, "KLOW2": down, "KSFT2": shift}
    return {n: x / base for n, x in over_open.items()} | {n: x / span for n, x in over_span.items()}


def price() -> dict[str, Expr]:
    return {f"{n}0": x / ts.not_zero(close) for n, x in (("OPEN", open_), ("HIGH", high), ("LOW", low), ("VWAP", vwap))}


def _line(w: int, least: int) -> tuple[Expr, Expr, Expr]:
    """Slope, r squared and last residual of the line through the closes of the window; missing if one of them is."""
    row = windowed(("row",), lambda: F.row_number().over(ts.order()).cast("double"))
    frame = lambda: ts.rows(w)

    def full(name, agg):
        return windowed((name, w, least), lambda c, r: F.when((F.count(c).over(frame()) == F.count(F.lit(1)).over(frame())) & (F.count(c).over(frame()) >= least), agg(c, r)), close, row)

    slope = full("slope", lambda c, r: F.try_divide(F.covar_pop(c, r).over(frame()), F.var_pop(r).over(frame())))
    middle, at = full("line mean", lambda c, r: F.avg(c).over(frame())), full("line at", lambda c, r: F.avg(r).over(frame()))
    vary = full("line var", lambda c, r: F.var_pop(c).over(frame()))
    spread = full("row var", lambda c, r: F.var_pop(r).over(frame()))
    square = ts.when(ts.highest(close, w, 1) > ts.lowest(close, w, 1), slope * slope * spread / vary, ts.when(as_expr(apply("some", lambda c: c.isNotNull(), slope)), 0.0))
    return slope, square, close - (middle + slope * (row - at))


def _moves(x: Expr, w: int, least: int, p: str) -> dict[str, Expr]:
    """Sums of rises, falls and both, over the sum of the magnitudes of the moves."""
    d = ts.delta(x, 1)
    all_ = ts.total(ts.absolute(d), w, least) + EPS
    return {f"{p}SUMP{w}": ts.total(ts.larger(d, 0.0), w, least) / all_, f"{p}SUMN{w}": ts.total(ts.absolute(ts.smaller(d, 0.0)), w, least) / all_, f"{p}SUMD{w}": ts.total(d, w, least) / all_}


def rolling(w: int) -> dict[str, Expr]:
    least = max(5, w // 2)
    c = ts.not_zero(close)
    ret, vol_ret = ts.pct_change(close, 1), ts.pct_change(volume, 1)
    slope, square, rest = _line(w, least)
    top, floor = ts.argmax(high, w, least) - 1, ts.argmin(low, w, least) - 1
    up, down = (ts.mean(ts.when(t, 1.0, 0.0), w, least) for t in (ts.delta(close, 1) > 0, ts.delta(close, 1) < 0))
    flow = ts.absolute(ret) * volume
    out = {
        f"ROC{w}": ts.ref(close, 1) / ts.not_zero(ts.ref(close, w + 1)) - 1,
        f"MA{w}": ts.mean(close, w, least) / c,
        f"STD{w}": ts.std(close, w, least) / c,
        f"BETA{w}": slope / c,
        f"RSQR{w}": square,
        f"RESI{w}": rest / c,
        f"MAX{w}": ts.highest(high, w, least) / c,
        f"MIN{w}": ts.lowest(low, w, least) / c,
        f"QTLU{w}": ts.quantile(close, w, 0.8, least) / c,
        f"QTLD{w}": ts.quantile(close, w, 0.2, least) / c,
        f"RANK{w}": cs.rank_pct(ts.mean(close, w, least)),
        f"RSV{w}": (close - ts.lowest(low, w, least)) / (ts.highest(high, w, least) - ts.lowest(low, w, least) + EPS),
        f"IMAX{w}": top / float(w),
        f"IMIN{w}": floor / float(w),
        f"IMXD{w}": (top - floor) / float(w),
        f"CORR{w}": ts.corr(close, ts.log(volume + 1), w, least),
        f"CORD{w}": ts.corr(ret, ts.log(ts.absolute(vol_ret) + 1), w, least),
        f"CNTP{w}": up,
        f"CNTN{w}": down,
        f"CNTD{w}": up - down,
        f"VMA{w}": ts.mean(volume, w, least) / (volume + EPS),
        f"VSTD{w}": ts.std(volume, w, least) / (volume + EPS),
        f"WVMA{w}": ts.std(flow, w, least) / (ts.mean(flow, w, least) + EPS),
    }
    return out | _moves(close, w, least, "") | _moves(volume, w, least, "V")


register("alpha158_kbar", candle())
register("alpha158_price", price())
for _w in WINDOWS:
    register(f"alpha158_rolling_{_w}", rolling(_w))
