"""Expressions over whole series in numpy: arrays of days by entities, some entities at a time.

The rules below give what the windows of ``ts`` give, from arrays in which a missing value is NaN. A rolling sum, extreme or
moment comes from running ones inside blocks of the window's length, from both ends of a block, so a row costs the same
whatever the window and nothing is ever subtracted. Windows of Spark go row by row instead, sort again for each rank and
keep all the columns of a level in their shuffles and sorts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from panelspark.expr import Expr

Array = np.ndarray

#: Ranks and places in a window compare its values one by one up to this length.
LONGEST = 64


def _divide(a, b):
    b = np.asarray(b, dtype=float)
    return np.where(b != 0, a / np.where(b != 0, b, 1.0), np.nan)


def _single(x: Array) -> Array:
    near = np.copysign(np.floor(np.abs(x) * 1e10 + 0.5), x) / 1e10
    return np.where(np.isfinite(near), near, x).astype(np.float32).astype(float)


#: Functions of a row. Comparisons with NaN are false, as they are with a missing value.
ROW_RULES: dict[str, Callable] = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "div": _divide,
    "pow": lambda a, b: np.where(np.isnan(a) | np.isnan(b), np.nan, np.power(a, b)),
    "neg": lambda a: -a,
    "lt": lambda a, b: np.less(a, b),
    "le": lambda a, b: np.less_equal(a, b),
    "gt": lambda a, b: np.greater(a, b),
    "ge": lambda a, b: np.greater_equal(a, b),
    "and": np.logical_and,
    "or": np.logical_or,
    "not": np.logical_not,
    "when": lambda t, a: np.where(t, a, np.nan),
    "when else": np.where,
    "where both": lambda a, b: np.where(np.isnan(b), np.nan, a),
    "larger": np.maximum,
    "smaller": np.minimum,
    "log": lambda a: np.where(a > 0, np.log(np.where(a > 0, a, 1.0)), np.nan),
    "abs": np.abs,
    "sign": np.sign,
    "sqrt": lambda a: np.where(a >= 0, np.sqrt(np.where(a >= 0, a, 0.0)), np.nan),
    "positive": lambda a: np.where(a > 0, a, np.nan),
    "not zero": lambda a: np.where(a != 0, a, np.nan),
    "single": _single,
    "zero": lambda a: np.where(np.isnan(a), 0.0, a),
    "some": lambda a: ~np.isnan(a),
}


def shifted(x: Array, n: int) -> Array:
    """The values n days before."""
    out = np.full_like(x, np.nan)
    if n < len(x):
        out[n:] = x[: len(x) - n]
    return out


def counted(there: Array, n: int) -> Array:
    """How many of the last n days are marked."""
    upto = np.cumsum(there, axis=0, dtype=np.int64)
    out = upto.copy()
    out[n:] -= upto[:-n]
    return out


def rolled(parts: tuple[Array, ...], none: tuple[float, ...], combine: Callable, n: int) -> tuple[Array, ...]:
    """What ``combine`` (associative, ``none`` its neutral element) makes of the last n days.

    A window is the end of one block of n days and the start of the next: running results from both ends of the blocks meet.
    """
    t, e = parts[0].shape
    blocks = -(-(t + n) // n)

    def laid(x: Array, empty: float) -> Array:
        out = np.full((blocks * n, e), empty)
        out[n - 1 : n - 1 + t] = x
        return out.reshape(blocks, n, e)

    x = [laid(p, z) for p, z in zip(parts, none, strict=True)]
    tail = [p.copy() for p in x]
    head = [np.full_like(p, z) for p, z in zip(x, none, strict=True)]
    for j in range(n - 2, -1, -1):
        for to, v in zip(tail, combine([p[:, j] for p in x], [p[:, j + 1] for p in tail]), strict=True):
            to[:, j] = v
    for j in range(1, n):
        for to, v in zip(head, combine([p[:, j - 1] for p in head], [p[:, j - 1] for p in x]), strict=True):
            to[:, j] = v
    return tuple(combine([p.reshape(-1, e)[:t] for p in tail], [p.reshape(-1, e)[n : n + t] for p in head]))


def _one(f: Callable) -> Callable:
    return lambda a, b: [f(a[0], b[0])]


def _sums(x: Array, there: Array, n: int) -> Array:
    return rolled((np.where(there, x, 0.0),), (0.0,), _one(np.add), n)[0]


def _with(a, b):
    """Counts, means and sums of products of deviations of two sets of pairs taken together."""
    ka, xa, ya, ca = a
    kb, xb, yb, cb = b
    k = ka + kb
    share = kb / np.maximum(k, 1.0)
    dx, dy = xb - xa, yb - ya
    return [k, xa + dx * share, ya + dy * share, ca + cb + dx * dy * (ka * share)]


def _with_squares(a, b):
    ka, xa, ca = a
    kb, xb, cb = b
    k = ka + kb
    share = kb / np.maximum(k, 1.0)
    d = xb - xa
    return [k, xa + d * share, ca + cb + d * d * (ka * share)]


def _deviations(x: Array, y: Array | None, there: Array, n: int) -> Array:
    """Sum of the products of the deviations of the pairs of the window from their means."""
    k, x = there.astype(float), np.where(there, x, 0.0)
    if y is None:
        return rolled((k, x, np.zeros_like(x)), (0.0,) * 3, _with_squares, n)[2]
    return rolled((k, x, np.where(there, y, 0.0), np.zeros_like(x)), (0.0,) * 4, _with, n)[3]


def _over(a: Array, k: Array) -> Array:
    return np.where(k > 0, a / np.maximum(k, 1), np.nan)


_AGGREGATES: dict[str, Callable] = {
    "mean": lambda x, k, ok, n: _over(_sums(x, ok, n), k),
    "sum": lambda x, k, ok, n: _sums(x, ok, n),
    "count": lambda x, k, ok, n: k.astype(float),
    "max": lambda x, k, ok, n: rolled((x,), (np.nan,), _one(np.fmax), n)[0],
    "min": lambda x, k, ok, n: rolled((x,), (np.nan,), _one(np.fmin), n)[0],
    "product": lambda x, k, ok, n: rolled((np.where(ok, x, 1.0),), (1.0,), _one(np.multiply), n)[0],
    "std": lambda x, k, ok, n: np.sqrt(_over(_deviations(x, None, ok, n), k - 1)),
}


def _rolling(name: str, n: int, least: int, x: Array, y: Array | None = None) -> Array:
    ok = ~np.isnan(x) if y is None else ~(np.isnan(x) | np.isnan(y))
    k = counted(ok, n)
    found = _over(_deviations(x, y, ok, n), k - 1) if name == "cov" else _AGGREGATES[name](x, k, ok, n)
    return np.where((k >= least) & ((k > 0) | (name == "count")), found, np.nan)


def _line(name: str, n: int, least: int, x: Array, row: Array) -> Array:
    """Parts of the line through the values of the window, all of which are there."""
    ok = ~np.isnan(x)
    k, days = counted(ok, n), np.minimum(np.arange(1, len(x) + 1), n)[:, None]
    span = (days * days - 1) / 12.0  # variance of consecutive numbers
    if name == "slope":
        found = _divide(_over(_deviations(x, row, ok, n), k), span + 0.0 * x)
    elif name == "line mean":
        found = _over(_sums(x, ok, n), k)
    elif name == "line at":
        found = row - (days - 1) / 2
    elif name == "line var":
        found = _over(_deviations(x, None, ok, n), k)
    else:
        found = span + 0.0 * row
    return np.where((k == days) & (k >= least), found, np.nan)


def _rank(n: int, least: int, x: Array) -> Array:
    rank = np.ones_like(x)
    for k in range(1, min(n, len(x))):
        v, own = x[:-k], x[k:]
        rank[k:] += (v < own) + 0.5 * (v == own)
    ok = ~np.isnan(x)
    return np.where(ok & (counted(ok, n) >= least), rank, np.nan)


def _place(name: str, n: int, least: int, x: Array) -> Array:
    """1-based place of the first extreme value; the window's first day is the first one there is."""
    x, ok = (x if name == "argmax" else -x), ~np.isnan(x)
    best, at = np.full_like(x, -np.inf), np.full(x.shape, np.nan)
    days = np.arange(len(x))[:, None]
    first = np.maximum(days - n + 1, 0)
    for age in range(min(n, len(x)) - 1, -1, -1):
        v, to = x[: len(x) - age], slice(age, None)
        more = (v > best[to]) | (np.isnan(at[to]) & ok[: len(x) - age])
        best[to] = np.where(more, v, best[to])
        at[to] = np.where(more, (days - age - first)[to] + 1.0, at[to])
    return np.where(counted(ok, n) >= least, at, np.nan)


def _quantile(p: float, n: int, least: int, x: Array) -> Array:
    t, e = x.shape
    k = counted(~np.isnan(x), n)
    at = np.maximum(k - 1, 0) * p
    lo = np.floor(at).astype(np.int64)
    out = np.empty((t, e))
    padded = np.concatenate([np.full((n - 1, e), np.nan), x])
    windows = np.lib.stride_tricks.sliding_window_view(padded, n, axis=0)
    step = max(1, 200_000 // (n * e))
    for s in range(0, t, step):
        v, own = np.sort(windows[s : s + step], axis=2), lo[s : s + step]
        low = np.take_along_axis(v, own[..., None], 2)[..., 0]
        high = np.take_along_axis(v, np.minimum(own + 1, n - 1)[..., None], 2)[..., 0]
        high = np.where(np.isnan(high), low, high)
        out[s : s + step] = low + (high - low) * (at[s : s + step] - own)
    return np.where(k >= max(least, 1), out, np.nan)


def _rank_whole(x: Array) -> Array:
    """Average-tie share of the rank of each value among all of its entity."""
    x = np.ascontiguousarray(x.T)
    e, t = x.shape
    order = np.argsort(x, axis=1)
    v = np.take_along_axis(x, order, 1)
    new = np.ones((e, t), bool)
    new[:, 1:] = v[:, 1:] != v[:, :-1]
    group = np.cumsum(new.ravel()) - 1
    start = np.flatnonzero(new.ravel())
    size = np.diff(np.r_[start, e * t])
    rank = (start % t + 1 + (size - 1) / 2)[group].reshape(e, t)
    share = _over(rank, (~np.isnan(x)).sum(axis=1)[:, None])
    out = np.empty_like(x)
    np.put_along_axis(out, order, np.where(np.isnan(v), np.nan, share), 1)
    return out.T


def _filled(x: Array, n: int | None) -> Array:
    at = np.maximum.accumulate(np.where(np.isnan(x), -1, np.arange(len(x))[:, None]), axis=0)
    found = np.take_along_axis(x, np.maximum(at, 0), 0)
    return np.where((at < 0) | ((np.arange(len(x))[:, None] - at > n) if n is not None else False), np.nan, found)


def _sum_abs(x: Array) -> Array:
    total = np.where(np.isnan(x).all(axis=0), np.nan, np.nansum(np.abs(x), axis=0))
    return np.broadcast_to(total, x.shape)


_BY_WINDOW = {*_AGGREGATES, "cov"}
_LINES = {"slope", "line mean", "line at", "line var", "row var"}


def _inner(e: Expr) -> tuple[Expr, ...] | None:
    """The expressions a node is computed from; None if there is no rule for it."""
    name, *rest = e.key[0] if isinstance(e.key[0], tuple) else (e.key[0],)
    if not e.window:
        return e.args if (isinstance(e.key[0], str) and name in ROW_RULES) or (isinstance(e.key[0], tuple) and name == "or") else None
    if name == "row":
        return ()
    if name in ("argmax", "argmin"):
        return e.args[0].args if rest[0] <= LONGEST else None  # of the held window
    if name == "quantile":
        return e.args[0].args[0].args if rest[1] <= 4 * LONGEST else None  # of the held window in order
    if name == "ts_rank":
        return e.args if rest[0] <= LONGEST else None
    if name == "fill back" or name == "fill" or name in ("ref", "rank whole", "sum abs") or (name in _BY_WINDOW and len(rest) == 2) or name in _LINES:
        return e.args
    return None


_AHEAD = {"rank whole", "sum abs", "fill back"}


def _window(head, args: list[Array], shape: tuple[int, int], there: Array | None) -> Array:
    name, *rest = head if isinstance(head, tuple) else (head,)
    args = [np.broadcast_to(np.asarray(a, dtype=float), shape) for a in args]
    if there is not None and name in _AHEAD:
        args = [np.where(there, a, np.nan) for a in args]
    if name == "row":
        return np.broadcast_to(np.arange(1.0, shape[0] + 1)[:, None], shape)
    if name == "ref":
        return shifted(args[0], rest[0])
    if name in _BY_WINDOW:
        return _rolling(name, *rest, *args)
    if name in _LINES:
        return _line(name, *rest, *args)
    if name == "ts_rank":
        return _rank(*rest, *args)
    if name in ("argmax", "argmin"):
        return _place(name, *rest, *args)
    if name == "quantile":
        p, n, least = rest
        return _quantile(p, n, max(1, n // 2) if least is None else least, *args)
    if name == "rank whole":
        return _rank_whole(*args)
    if name == "fill":
        return _filled(args[0], rest[0])
    if name == "fill back":
        return _filled(args[0][::-1], None)[::-1]
    return _sum_abs(*args)


class Program:
    """Expressions as steps (head, whether it is a window, numbers of the arguments); equal nodes are one step.

    ``ranks`` has what is ranked among the values of a date, by the name under which the ranks are given to ``run``.
    """

    def __init__(self, exprs: dict[str, Expr]):
        self.steps: list[tuple[object, bool, tuple[int, ...]]] = []
        self.ranks: dict[str, Expr] = {}
        self.measures: list[str] = []
        self._known: dict[tuple, int] = {}
        self._seen: dict[int, int] = {}
        self._given: set[int] = set()
        self.outputs = {n: self._number(e) for n, e in exprs.items()}
        self._seen.clear()
        self.windows = any(window for _, window, _ in self.steps)
        self.last: list[list[int]] = [[] for _ in self.steps]
        final = {k: len(self.steps) for k in self.outputs.values()}
        for k, (_, _, args) in enumerate(self.steps):
            for a in args:
                final[a] = max(final.get(a, 0), k)
        for k, at in final.items():
            if at < len(self.steps):
                self.last[at].append(k)

    def __getstate__(self) -> dict:
        """What ``run`` needs in a worker."""
        return {k: getattr(self, k) for k in ("steps", "measures", "outputs", "last")}

    def _number(self, e: Expr) -> int:
        if id(e) in self._seen:
            return self._seen[id(e)]
        if e.window and e.key[0] == "rank pct":
            head, args = ("given", e.args[0]), (self._number(e.args[0]),)
            if args[0] in self._given:
                raise NotImplementedError("a rank of ranks")
        elif e.key[0] in ("measure", "literal"):
            head, args = tuple(e.key), ()
        else:
            inner = _inner(e)
            if inner is None:
                raise NotImplementedError(f"no rule for {e.key[0]}")
            head, args = e.key[0], tuple(map(self._number, inner))
        ranked = isinstance(head, tuple) and head[0] == "given"
        key = ("given", *args) if ranked else (head, *args)
        if key not in self._known:
            if ranked:
                # What is ranked is computed in a pass of its own.
                name = f"_r{len(self.ranks)}"
                self.ranks[name] = head[1]
                head = ("given", name)
            if e.window and not ranked and any(a in self._given for a in args):
                raise NotImplementedError("a window over ranks of dates")
            self._known[key] = len(self.steps)
            if ranked or any(a in self._given for a in args):
                self._given.add(len(self.steps))
            if head[0] == "measure":
                self.measures.append(head[1])
            self.steps.append((head, e.window, () if ranked else args))
        self._seen[id(e)] = self._known[key]
        return self._known[key]

    def run(self, measures: dict[str, Array], given: dict[str, Array] | None = None, there: Array | None = None) -> dict[str, Array]:
        """The expressions over arrays of days by entities; an array goes after its last use.

        ``there`` tells the days of an entity from the empty ones after its last day, which what reads ahead must not see.
        """
        shape = next(iter(measures.values())).shape
        found: list = [None] * len(self.steps)
        with np.errstate(all="ignore"):
            for k, (head, window, own) in enumerate(self.steps):
                name = head[0] if isinstance(head, tuple) else head
                if name == "measure":
                    found[k] = measures[head[1]]
                elif name == "literal":
                    found[k] = head[1]
                elif name == "given":
                    found[k] = given[head[1]]
                elif window:
                    found[k] = _window(head, [found[a] for a in own], shape, there)
                elif isinstance(head, tuple):
                    found[k] = np.where(np.isnan(found[own[0]]), head[1], found[own[0]])
                else:
                    found[k] = ROW_RULES[head](*(found[a] for a in own))
                for a in self.last[k]:
                    found[a] = None
        return {n: np.broadcast_to(np.asarray(found[k], dtype=float), shape) for n, k in self.outputs.items()}


def program(exprs: dict[str, Expr]) -> Program | None:
    """None where a node has no rule, or a window reads a rank of a date."""
    try:
        return Program(exprs)
    except NotImplementedError:
        return None
