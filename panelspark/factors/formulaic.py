"""Formulaic alphas (after Z. Kakushadze, "101 Formulaic Alphas", 2016) that need no industry or cap data.

The conventions are those of the inventory: volume counts in hundreds, the first return is 0, ranks and scales run over
the whole series of an entity (so they read the future: ``lookahead``), correlations and covariances need three pairs and
are 0 where undefined, and comparisons give 1 or 0. What is ranked is first rounded (``single``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.expr import Expr, apply, as_expr, measure
from panelspark.factors.registry import register
from panelspark.operators import ts
from panelspark.operators.ts import decay_linear as decay
from panelspark.operators.ts import delta, larger, log, not_zero, or_else, ref, sign, smaller, when
from panelspark.operators.ts import scale_whole as scale

o, h, l, c, w = map(measure, ("open", "high", "low", "close", "vwap"))  # noqa: E741
v = measure("volume") * 100
ret = or_else(ts.pct_change(c, 1), 0.0)
mid, span = (h + l) / 2, h - l


def single(x) -> Expr:
    """To ten decimals and in single precision: values that only differ by the order of their sums are ties in a rank."""
    x = as_expr(x)
    return x if x.key[0] == "measure" else apply("single", lambda c: F.round(c, 10).cast("float").cast("double"), x)


def rank(x) -> Expr:
    return ts.rank_whole(single(x))


def ts_rank(x, n: int) -> Expr:
    return ts.ts_rank(single(x), n)


def argmax(x, n: int) -> Expr:
    return ts.argmax(single(x), n)


def argmin(x, n: int) -> Expr:
    return ts.argmin(single(x), n)


def sum_(x, n: int) -> Expr:
    return ts.total(x, n, 1)


def avg(x, n: int) -> Expr:
    return ts.mean(x, n, 1)


def dev(x, n: int) -> Expr:
    return ts.std(x, n, 2)


def top(x, n: int) -> Expr:
    return ts.highest(x, n, 1)


def low(x, n: int) -> Expr:
    return ts.lowest(x, n, 1)


def corr(x, y, n: int) -> Expr:
    return or_else(ts.corr(x, y, n, 3), 0.0)


def cov(x, y, n: int) -> Expr:
    return or_else(ts.cov(x, y, n, 3), 0.0)


def adv(n: int) -> Expr:
    return avg(v, n)


def less(a, b) -> Expr:
    return when(as_expr(a) < b, 1.0, 0.0)


def mix(a, b, share: float) -> Expr:
    return a * share + b * (1 - share)


def nonzero(x, instead: float) -> Expr:
    return or_else(not_zero(x), instead)


def _turn(bound_up: float | None, bound_down: float) -> Expr:
    """One-day reversal, replaced by 1 or -1 where the ten-day slopes of the close differ by more than the bounds."""
    bend = (ref(c, 20) - ref(c, 10)) / 10 - (ref(c, 10) - c) / 10
    base = when(bend < bound_down, 1.0, -delta(c, 1))
    return base if bound_up is None else when(bend > bound_up, -1.0, base)


def _trend(n: int) -> Expr:
    """The day's change while all of the last n have one sign, else its opposite."""
    d = delta(c, 1)
    return when((low(d, n) > 0) | (top(d, n) < 0), d, -d)


def alphas() -> dict[str, Expr]:
    d1 = delta(c, 1)
    signs = sign(d1) + sign(ref(d1, 1)) + sign(ref(d1, 2))
    steps = rank(delta(c - 1, 5))
    f = {
        1: rank(argmax(when(ret >= 0, c, dev(ret, 20)) ** 2, 5)) - 0.5,
        2: -corr(rank(delta(log(v), 2)), rank((c - o) / o), 6),
        3: -corr(rank(o), rank(v), 10),
        4: -ts_rank(rank(l), 9),
        5: rank(o - sum_(w, 10) / 10) * -ts.absolute(rank(c - w)),
        6: -corr(o, v, 10),
        7: when(adv(20) < v, -ts_rank(ts.absolute(delta(c, 7)), 60) * sign(delta(c, 7)), -1.0),
        8: -rank(delta(sum_(o, 5) * sum_(ret, 5), 10)),
        9: _trend(5),
        10: rank(_trend(4)),
        11: (rank(top(w - c, 3)) + rank(low(w - c, 3))) * rank(delta(v, 3)),
        12: sign(delta(v, 1)) * -d1,
        13: -rank(cov(rank(c), rank(v), 5)),
        14: -rank(delta(ret, 3)) * corr(o, v, 10),
        15: -sum_(rank(corr(rank(h), rank(v), 3)), 3),
        16: -rank(cov(rank(h), rank(v), 5)),
        17: -rank(ts_rank(c, 10)) * rank(delta(d1, 1)) * rank(ts_rank(v / adv(20), 5)),
        18: -rank(dev(ts.absolute(c - o), 5) + (c - o) + corr(c, o, 10)),
        19: -sign(c - ref(c, 7) + delta(c, 7)) * (1 + rank(1 + sum_(ret, 250))),
        20: -rank(o - ref(h, 1)) * rank(o - ref(c, 1)) * rank(o - ref(l, 1)),
        21: when((avg(c, 8) + dev(c, 8) < avg(c, 2)) | (adv(20) / v < 1), 1.0, -1.0),
        22: -delta(corr(h, v, 5), 5) * rank(dev(c, 20)),
        23: when(avg(h, 20) < h, -or_else(delta(h, 2), 0.0), 0.0),
        24: when(delta(avg(c, 100), 100) / ref(c, 100) <= 0.05, -(c - low(c, 100)), -delta(c, 3)),
        25: rank(-ret * adv(20) * w * (h - c)),
        26: -top(corr(ts_rank(v, 5), ts_rank(h, 5), 5), 3),
        27: when(rank(avg(corr(rank(v), rank(w), 6), 2) / 2) > 0.5, -1.0, 1.0),
        28: scale(corr(adv(20), l, 5) + mid - c),
        29: low(ts.product(rank(rank(scale(log(sum_(low(rank(rank(-steps)), 2), 1))))), 1), 5) + ts_rank(ref(-ret, 6), 5),
        30: (1 - rank(signs)) * sum_(v, 5) / not_zero(sum_(v, 20)),
        31: rank(rank(rank(decay(-rank(rank(delta(c, 10))), 10)))) + rank(-delta(c, 3)) + sign(scale(corr(adv(20), l, 12))),
        32: scale(avg(c, 7) - c) + 20 * scale(corr(w, ref(c, 5), 230)),
        33: rank(-1 + o / c),
        34: rank(2 - rank(or_else(dev(ret, 2) / not_zero(dev(ret, 5)), 1.0)) - rank(d1)),
        35: ts_rank(v, 32) * (1 - ts_rank(c + h - l, 16)) * (1 - ts_rank(ret, 32)),
        36: 2.21 * rank(corr(c - o, ref(v, 1), 15)) + 0.7 * rank(o - c) + 0.73 * rank(ts_rank(ref(-ret, 6), 5)) + rank(ts.absolute(corr(w, adv(20), 6))) + 0.6 * rank((avg(c, 200) - o) * (c - o)),
        37: rank(corr(ref(o - c, 1), c, 200)) + rank(o - c),
        38: -rank(ts_rank(o, 10)) * rank(or_else(c / not_zero(o), 1.0)),
        39: -rank(delta(c, 7) * (1 - rank(decay(v / adv(20), 9)))) * (1 + rank(avg(ret, 250))),
        40: -rank(dev(h, 10)) * corr(h, v, 10),
        41: ts.sqrt(h * l) - w,
        42: rank(w - c) / not_zero(rank(w + c)),
        43: ts_rank(v / adv(20), 20) * ts_rank(-delta(c, 7), 8),
        44: -corr(h, rank(v), 5),
        45: -rank(avg(ref(c, 5), 20)) * corr(c, v, 2) * rank(corr(sum_(c, 5), sum_(c, 20), 2)),
        46: _turn(0.25, 0.0),
        47: rank(1 / not_zero(c)) * v / adv(20) * not_zero(h * rank(h - c) / avg(h, 5)) - rank(w - ref(w, 5)),
        49: _turn(None, -0.1),
        50: -top(rank(corr(rank(v), rank(w), 5)), 5),
        51: _turn(None, -0.05),
        52: -delta(low(l, 5), 5) * rank((sum_(ret, 240) - sum_(ret, 20)) / 220) * ts_rank(v, 5),
        53: -delta((c - l - (h - c)) / nonzero(c - l, 0.0001), 9),
        54: -(l - c) * o**5 / (nonzero(l - h, -0.0001) * c**5),
        55: -corr(rank((c - low(l, 12)) / nonzero(top(h, 12) - low(l, 12), 0.0001)), rank(v), 6),
        57: -(c - w) / not_zero(decay(rank(argmax(c, 30)), 2)),
        60: -(2 * scale(rank((c - l - (h - c)) * v / nonzero(span, 0.0001))) - scale(rank(argmax(c, 10)))),
        61: less(rank(w - low(w, 16)), rank(corr(w, adv(180), 18))),
        62: -less(rank(corr(w, avg(adv(20), 22), 10)), rank(less(rank(o) + rank(o), rank(mid) + rank(h)))),
        64: -less(rank(corr(avg(mix(o, l, 0.178404), 13), avg(adv(120), 13), 17)), rank(delta(mix(mid, w, 0.178404), 4))),
        65: -less(rank(corr(mix(o, w, 0.00817205), avg(adv(60), 9), 6)), rank(o - low(o, 14))),
        66: -(rank(decay(delta(w, 4), 7)) + ts_rank(decay((l - w) / not_zero(o - mid), 11), 7)),
        68: -less(ts_rank(corr(rank(h), rank(adv(15)), 9), 14), rank(delta(c * 0.518371 + l * 0.481629, 1))),
        71: larger(ts_rank(decay(corr(ts_rank(c, 3), ts_rank(adv(180), 12), 18), 4), 16), ts_rank(decay(rank((l + o - 2 * w) ** 2), 16), 4)),
        72: rank(decay(corr(mid, adv(40), 9), 10)) / not_zero(rank(decay(corr(ts_rank(w, 4), ts_rank(v, 19), 7), 3))),
        73: -larger(rank(decay(delta(w, 5), 3)), ts_rank(decay(-delta(mix(o, l, 0.147155), 2) / mix(o, l, 0.147155), 3), 17)),
        74: -less(rank(corr(c, avg(adv(30), 37), 15)), rank(corr(rank(h * 0.0261661 + w * 0.9738339), rank(v), 11))),
        75: less(rank(corr(w, v, 4)), rank(corr(rank(l), rank(adv(50)), 12))),
        77: smaller(rank(decay(mid - w, 20)), rank(decay(corr(mid, adv(40), 3), 6))),
        78: rank(corr(sum_(l * 0.352233 + w * 0.647767, 20), sum_(adv(40), 20), 7)) ** rank(corr(rank(w), rank(v), 6)),
        81: -less(rank(log(ts.product(rank(rank(corr(w, sum_(adv(10), 50), 8))) ** 4, 15))), rank(corr(rank(w), rank(v), 5))),
        83: rank(ref(span / (sum_(c, 5) / 5), 2)) * rank(rank(v)) / not_zero(span / (sum_(c, 5) / 5) / (w - c)),
        84: ts_rank(w - top(w, 15), 21) ** delta(c, 5),
        85: rank(corr(h * 0.876703 + c * 0.123297, adv(30), 10)) ** rank(corr(ts_rank(mid, 4), ts_rank(v, 10), 7)),
        86: -less(ts_rank(corr(c, avg(adv(20), 15), 6), 20), rank(c - w)),
        88: smaller(rank(decay(rank(o) + rank(l) - rank(h) - rank(c), 8)), ts_rank(decay(corr(ts_rank(c, 8), ts_rank(adv(60), 21), 8), 7), 3)),
        92: smaller(ts_rank(decay(less(mid + c, l + o), 15), 19), ts_rank(decay(corr(rank(l), rank(adv(30)), 8), 7), 7)),
        94: -(rank(w - low(w, 12)) ** ts_rank(corr(ts_rank(w, 20), ts_rank(adv(60), 4), 18), 3)),
        95: less(rank(o - low(o, 12)), ts_rank(rank(corr(avg(mid, 19), avg(adv(40), 19), 13)) ** 5, 12)),
        96: -larger(ts_rank(decay(corr(rank(w), rank(v), 4), 4), 8), ts_rank(decay(argmax(corr(ts_rank(c, 7), ts_rank(adv(60), 4), 4), 13), 14), 13)),
        98: rank(decay(corr(w, avg(adv(5), 26), 5), 7)) - rank(decay(ts_rank(argmin(corr(rank(o), rank(adv(15)), 21), 9), 7), 8)),
        99: -less(rank(corr(sum_(mid, 20), sum_(adv(60), 20), 9)), rank(corr(l, v, 6))),
        101: (c - o) / (span + 0.001),
    }
    return {f"alpha{k:03d}": x for k, x in f.items()}


ALPHAS = alphas()
register("formulaic", ALPHAS, lookahead=True)
