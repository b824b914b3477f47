"""Time-series operators: windows over the rows of an entity in date order. All take and give expressions."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from panelspark.expr import Expr, apply, as_expr, over_series, windowed
from panelspark.operators.order import rank_in_window


# Windows are made when an expression is built: importing this module needs no session.
_RANGED = {"ref", "mean", "sum", "std", "max", "min", "product", "cov", "count", "skewness"}
_MODE: ContextVar[str] = ContextVar("windows", default="rows")


@contextmanager
def _mode(name: str) -> Iterator[None]:
    held = _MODE.set(name)
    try:
        yield
    finally:
        _MODE.reset(held)


def by_slots():
    """While it holds, windows count trading days (column ``slot``) by RANGE frames; only for what ``ranged`` allows."""
    return _mode("range")


def in_slots():
    """While it holds, rows stand in the order of the column ``slot``."""
    return _mode("slot")


def ranged(e: Expr) -> bool:
    """Whether a window is a rolling aggregate or a shift, which need no row for the days between."""
    name = e.key[0]
    return isinstance(name, tuple) and name[0] in _RANGED


def day() -> str:
    """The column that tells the days apart and orders them."""
    return "dt" if _MODE.get() == "rows" else "slot"


def order():
    """The rows of an entity in date order."""
    return Window.partitionBy("entity").orderBy(day())


def whole():
    return Window.partitionBy("entity")


def within(block: Column):
    """The rows of an entity's block in date order."""
    return Window.partitionBy("entity", block).orderBy(day())


def upto():
    return order().rowsBetween(Window.unboundedPreceding, 0)


def rows(n: int, end: int = 0):
    """The last n rows up to the current one (or up to ``end`` rows from it)."""
    return (order().rangeBetween if _MODE.get() == "range" else order().rowsBetween)(end - int(n) + 1, end)


def before(c: Column, n: int) -> Column:
    """The value n rows before."""
    # An entity has one row a day at most, so a frame of one day holds one value.
    return F.max(c).over(rows(1, -n)) if _MODE.get() == "range" else F.lag(c, n).over(order())


def _rolling(name: str, agg, n: int, least: int, *args) -> Expr:
    """``agg`` over the last n rows where at least ``least`` of them have all arguments."""
    n = int(n)

    def build(*cols: Column) -> Column:
        full = cols[0].isNotNull()
        for c in cols[1:]:
            full = full & c.isNotNull()
        return F.when(F.count(F.when(full, 1)).over(rows(n)) >= least, agg(*cols).over(rows(n)))

    return windowed((name, n, least), build, *args)


def half(n: int) -> int:
    return max(1, int(n) // 2)


def ref(x, n: int = 1) -> Expr:
    """The value n rows before; a negative n also looks back."""
    n = abs(int(n))
    return windowed(("ref", n), lambda c: before(c, n), x) if n else as_expr(x)


def lead(x, n: int = 1) -> Expr:
    return windowed(("lead", n), lambda c: F.lead(c, n).over(order()), x)


def delta(x, n: int = 1) -> Expr:
    return as_expr(x) - ref(x, n)


def pct_change(x, n: int = 1) -> Expr:
    return as_expr(x) / ref(x, n) - 1


def mean(x, n: int, least: int | None = None) -> Expr:
    return _rolling("mean", F.avg, n, half(n) if least is None else least, x)


def total(x, n: int, least: int | None = None) -> Expr:
    return _rolling("sum", F.sum, n, half(n) if least is None else least, x)


def std(x, n: int, least: int | None = None) -> Expr:
    return _rolling("std", F.stddev_samp, n, half(n) if least is None else least, x)


def highest(x, n: int, least: int | None = None) -> Expr:
    return _rolling("max", F.max, n, half(n) if least is None else least, x)


def lowest(x, n: int, least: int | None = None) -> Expr:
    return _rolling("min", F.min, n, half(n) if least is None else least, x)


def held(x, n: int) -> Expr:
    """The values of the last n rows as an array (missing ones keep their places); what ranks, places and quantiles share."""
    return windowed(("held", n), lambda c: F.transform(F.collect_list(F.struct(c.alias("v"))).over(rows(n)), lambda s: s["v"]), x)


def _of_held(name, build, x, n: int, least: int, *more) -> Expr:
    """A function of the array where it holds enough values. It is a column of its own, so that arrays are dropped at once."""
    return windowed(name, lambda values, k, *cols: F.when(k >= least, build(values, *cols)), held(x, n), _rolling("count", F.count, n, 0, x), *more)


def quantile(x, n: int, p: float, least: int | None = None) -> Expr:
    """Exact, linearly interpolated."""
    ordered = windowed("ordered", lambda v: F.array_sort(F.filter(v, lambda e: e.isNotNull())), held(x, n))
    count = _rolling("count", F.count, n, 0, x)

    def build(v: Column, k: Column) -> Column:
        at = (k - 1) * F.lit(float(p))
        lo = F.floor(at).cast("int")
        return F.when(k >= max(half(n) if least is None else least, 1), F.get(v, lo) + (F.coalesce(F.get(v, lo + 1), F.get(v, lo)) - F.get(v, lo)) * (at - lo))

    return windowed(("quantile", p, n, least), build, ordered, count)


def product(x, n: int, least: int = 1) -> Expr:
    return _rolling("product", F.product, n, least, x)


def corr(x, y, n: int, least: int = 2) -> Expr:
    """Pearson correlation of the pairs in the window; NULL where a side does not vary."""
    x, y = as_expr(x), as_expr(y)
    both = lambda a, b: apply("where both", lambda p, q: F.when(q.isNotNull(), p), a, b)
    a, b = both(x, y), both(y, x)
    varies = (highest(a, n, 1) > lowest(a, n, 1)) & (highest(b, n, 1) > lowest(b, n, 1))
    return when(varies, cov(a, b, n, least) / (std(a, n, least) * std(b, n, least)))


def cov(x, y, n: int, least: int = 2) -> Expr:
    return _rolling("cov", F.covar_samp, n, least, x, y)


def moment_about_own_mean(x, n: int, power: int) -> Expr:
    """Mean over the window of (x - its own row's rolling mean)**power, over the rolling std**power."""
    return mean((as_expr(x) - mean(x, n)) ** power, n) / std(x, n) ** power


def skew_own(x, n: int) -> Expr:
    return moment_about_own_mean(x, n, 3)


def kurt_own(x, n: int) -> Expr:
    return moment_about_own_mean(x, n, 4)


def corr_own(x, y, n: int) -> Expr:
    """Sum of the products of own-row deviations over n times both standard deviations."""
    x, y = as_expr(x), as_expr(y)
    return total((x - mean(x, n)) * (y - mean(y, n)), n) / (std(x, n) * std(y, n) * float(n))


def skew_corrected(x, n: int, least: int = 3) -> Expr:
    """Sample skewness: the population one times sqrt(k (k - 1)) / (k - 2) of the k values in the window."""
    k = _rolling("count", F.count, n, max(least, 3), x)
    g = _rolling("skewness", F.skewness, n, max(least, 3), x)
    return g * apply("sqrt", F.sqrt, k * (k - 1)) / (k - 2)


def ewm(x, span: int, least: int | None = None) -> Expr:
    """Exponentially weighted mean with weights (1 - a)**age, a = 2 / (span + 1), over all rows so far; missing rows age the
    others, and a row without a value has none.

    Weights are kept relative to the start of a block of rows, so that sums stay in range whatever the length of the series;
    what is older than the block before the current one weighs less than 1e-100.
    """
    x, q = as_expr(x), 1 - 2 / (span + 1)
    least = span if least is None else least
    size = max(2, int(230 / -math.log(q)))
    row = windowed(("row",), lambda: F.row_number().over(order()))
    at = apply(("at", size), lambda r: (r - 1) % size, row)
    block = apply(("block", size), lambda r: F.floor((r - 1) / size), row)

    def so_far(v: Expr) -> Expr:
        raw = windowed(("block sum", q), lambda c, b, p: F.sum(c * F.pow(F.lit(q), -p)).over(within(b).rowsBetween(Window.unboundedPreceding, 0)), v, block, at)
        own = apply(("scale", q), lambda s, p: F.coalesce(s, F.lit(0.0)) * F.pow(F.lit(q), p), raw, at)
        before = windowed("first of block", lambda c, b: F.first(c).over(within(b).rowsBetween(Window.unboundedPreceding, 0)), ref(own, 1), block)
        return apply(("carry", q), lambda o, b, p: o + F.coalesce(b, F.lit(0.0)) * F.pow(F.lit(q), p + 1), own, before, at)

    there = apply("there", lambda c: F.when(c.isNotNull(), F.lit(1.0)), x)
    seen = windowed("seen", lambda c: F.count(c).over(upto()), x)
    return when((seen >= least) & apply("not null", lambda c: c.isNotNull(), x), so_far(x) / so_far(there))


def rsi(x, span: int = 14) -> Expr:
    """100 - 100 / (1 + mean gain / mean loss), both exponentially weighted; 100 where nothing was lost."""
    d = delta(x, 1)
    gain = ewm(when(d > 0, d, when(d <= 0, 0.0)), span)
    loss = ewm(when(d < 0, -d, when(d >= 0, 0.0)), span)
    return when(loss > 0, 100 - 100 / (1 + gain / loss), when(gain >= 0, 100.0))


def macd(x, fast: int = 12, slow: int = 26, signal: int = 9) -> tuple[Expr, Expr, Expr]:
    dif = ewm(x, fast) - ewm(x, slow)
    dea = ewm(dif, signal)
    return dif, dea, 2 * (dif - dea)


#: Windows up to here are compared value by value with shifted columns, longer ones by sorted blocks.
SHORT = 64


def ts_rank(x, n: int, least: int = 1) -> Expr:
    """Average rank (from 1) of the last value among those of the window."""
    if n > SHORT:
        return over_series(("ts_rank", n, least), lambda v: rank_in_window(v, n, least), x)

    def build(c: Column) -> Column:
        rank = F.lit(1.0)
        for k in range(1, int(n)):
            v = before(c, k)
            rank = rank + F.when(v < c, 1.0).when(v == c, 0.5).otherwise(0.0)
        return F.when(c.isNotNull() & (F.count(c).over(rows(n)) >= least), rank)

    return windowed(("ts_rank", n, least), build, x)


def pct_rank_rolling(x, n: int, least: int) -> Expr:
    """ts_rank as a share of the values in the window, times 100."""
    return ts_rank(x, n, least) / _rolling("count", F.count, n, least, x) * 100


def _arg(name: str, pick, x, n: int, least: int) -> Expr:
    """1-based place of the first extreme value in the window (missing rows keep their places)."""
    return _of_held((name, n, least), lambda values: F.array_position(values, pick(values)).cast("double"), x, n, least)


def argmax(x, n: int, least: int = 1) -> Expr:
    return _arg("argmax", F.array_max, x, n, least)


def argmin(x, n: int, least: int = 1) -> Expr:
    return _arg("argmin", F.array_min, x, n, least)


def fill_forward(x, n: int | None = None) -> Expr:
    """The last value that is not missing, at most n rows old."""
    return windowed(("fill", n), lambda c: F.last(c, ignorenulls=True).over(order().rowsBetween(Window.unboundedPreceding if n is None else -n, 0)), x)


def fill_backward(x) -> Expr:
    return windowed("fill back", lambda c: F.first(c, ignorenulls=True).over(order().rowsBetween(0, Window.unboundedFollowing)), x)


def decay_linear(x, n: int) -> Expr:
    """Weights 1..n over the last n rows (gaps filled from both sides, then 0); the first n - 1 rows keep their value."""
    filled = apply("zero", lambda c: F.coalesce(c, F.lit(0.0)), fill_backward(fill_forward(x)))
    row = windowed(("row",), lambda: F.row_number().over(order()))
    parts = as_expr(0.0)
    for age in range(n):
        parts = parts + ref(filled, age) * float(n - age)
    return when(row >= n, parts / (n * (n + 1) / 2), filled)


def rank_whole(x) -> Expr:
    """Average-tie share of the rank of each value among all of the entity (reads the future)."""
    def build(c: Column) -> Column:
        rank = F.rank().over(whole().orderBy(c.asc_nulls_last()))
        ties = F.count(F.lit(1)).over(Window.partitionBy("entity", c))
        return F.when(c.isNotNull(), (rank + (ties - 1) / 2) / F.count(c).over(whole()))

    return windowed("rank whole", build, x)


def scale_whole(x, k: float = 1.0) -> Expr:
    """x times k over the sum of the magnitudes of all values of the entity (reads the future)."""
    return as_expr(x) * k / windowed("sum abs", lambda c: F.sum(F.abs(c)).over(whole()), x)


def cumulative(x, agg=F.sum, name: str = "sum") -> Expr:
    return windowed(("so far", name), lambda c: agg(c).over(upto()), x)


def when(test: Expr, yes, no=None) -> Expr:
    """``yes`` where the test holds, else ``no`` (missing by default)."""
    if no is None:
        return apply("when", lambda t, a: F.when(t, a), test, yes)
    return apply("when else", lambda t, a, b: F.when(t, a).otherwise(b), test, yes, no)


def _both(name: str, pick):
    """R6: the larger or smaller of two values, missing where either is."""
    return lambda a, b: apply(name, lambda p, q: F.when(p.isNotNull() & q.isNotNull(), pick(p, q)), a, b)


larger, smaller = _both("larger", F.greatest), _both("smaller", F.least)


def log(x) -> Expr:
    return apply("log", lambda c: F.when(c > 0, F.log(c)), x)


def absolute(x) -> Expr:
    return apply("abs", F.abs, x)


def sign(x) -> Expr:
    return apply("sign", F.signum, x)


def sqrt(x) -> Expr:
    return apply("sqrt", lambda c: F.when(c >= 0, F.sqrt(c)), x)


def positive(x) -> Expr:
    """The value where it is above zero."""
    return apply("positive", lambda c: F.when(c > 0, c), x)


def not_zero(x) -> Expr:
    return apply("not zero", lambda c: F.when(c != 0, c), x)


def or_else(x, value: float) -> Expr:
    return apply(("or", value), lambda c: F.coalesce(c, F.lit(float(value))), x)
