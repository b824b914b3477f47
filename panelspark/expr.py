"""Lazy expressions over a panel (entity, dt, measures), evaluated in as few window stages as their nesting needs.

Spark does not nest window functions, so an expression is cut where a window reads another one. Equal sub-expressions are
one node and become one column. All nodes of a level go into one ``select``; windows over the same entity order share one
shuffle and one sort, and columns are dropped after their last use.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Expr:
    """A node: a measure, a function of a row, or a window function. Equal keys are equal nodes."""

    def __init__(self, key: tuple, build: Callable[..., Column], args: tuple[Expr, ...] = (), window: bool = False, series: Callable | None = None):
        self.key, self.build, self.args, self.window, self.series = key, build, args, window, series
        self.depth = max((a.depth for a in args), default=0) + window

    def __hash__(self) -> int:
        return hash(self.key)

    def __add__(self, other):
        return apply("add", lambda a, b: a + b, self, other)

    def __radd__(self, other):
        return as_expr(other) + self

    def __sub__(self, other):
        return apply("sub", lambda a, b: a - b, self, other)

    def __rsub__(self, other):
        return as_expr(other) - self

    def __mul__(self, other):
        return apply("mul", lambda a, b: a * b, self, other)

    def __rmul__(self, other):
        return as_expr(other) * self

    def __truediv__(self, other):
        return apply("div", F.try_divide, self, other)

    def __rtruediv__(self, other):
        return as_expr(other) / self

    def __pow__(self, other):
        return apply("pow", F.pow, self, other)

    def __neg__(self):
        return apply("neg", lambda a: -a, self)

    def _test(self, name: str, test: Callable[[Column, Column], Column], other) -> Expr:
        # A comparison with a missing value is false (rule R5).
        return apply(name, lambda a, b: F.coalesce(test(a, b), F.lit(False)), self, other)

    def __lt__(self, other):
        return self._test("lt", lambda a, b: a < b, other)

    def __le__(self, other):
        return self._test("le", lambda a, b: a <= b, other)

    def __gt__(self, other):
        return self._test("gt", lambda a, b: a > b, other)

    def __ge__(self, other):
        return self._test("ge", lambda a, b: a >= b, other)

    def __and__(self, other):
        return apply("and", lambda a, b: a & b, self, other)

    def __or__(self, other):
        return apply("or", lambda a, b: a | b, self, other)

    def __invert__(self):
        return apply("not", lambda a: ~a, self)


def measure(name: str) -> Expr:
    return Expr(("measure", name), lambda: F.col(name))


def as_expr(x) -> Expr:
    return x if isinstance(x, Expr) else Expr(("literal", float(x)), lambda: F.lit(float(x)))


def apply(name, build: Callable[..., Column], *args) -> Expr:
    """A function of one row; ``name`` (with its parameters) tells it from others."""
    own = tuple(as_expr(a) for a in args)
    return Expr((name, *(a.key for a in own)), build, own)


def windowed(name, build: Callable[..., Column], *args) -> Expr:
    """A window function; its arguments are columns by the time it is built."""
    own = tuple(as_expr(a) for a in args)
    return Expr((name, *(a.key for a in own)), build, own, window=True)


def over_series(name, compute: Callable, *args) -> Expr:
    """A function of whole series: ``compute`` takes an array (in date order, NaN where missing) for each argument and gives one."""
    own = tuple(as_expr(a) for a in args)
    return Expr((name, *(a.key for a in own)), None, own, window=True, series=compute)


def _with_series(panel: DataFrame, computed: list[tuple[str, Callable, list[str]]], order: str) -> DataFrame:
    """``panel`` with a column for each (name, function, inputs); the inputs go. One entity's series is one group of Arrow
    batches: as long as there are dates."""
    import numpy as np
    import pyarrow as pa

    inputs = {i for _, _, own in computed for i in own}
    rest = [c for c in panel.columns if c not in inputs]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        out = table.select(rest)
        for name, compute, own in computed:
            found = compute(*(np.array(table[i].to_numpy(zero_copy_only=False), dtype=float) for i in own))
            out = out.append_column(name, pa.array(found, mask=np.isnan(found)))
        return out

    schema = T.StructType([*(panel.schema[c] for c in rest), *(T.StructField(name, T.DoubleType()) for name, _, _ in computed)])
    return panel.groupBy("entity").applyInArrow(run, schema)


def evaluate(panel: DataFrame, exprs: dict[str, Expr], keep: tuple[str, ...] = ("entity", "dt")) -> DataFrame:
    """``keep`` columns of the panel and one column for each expression."""
    nodes: dict[tuple, Expr] = {}
    last_use: dict[tuple, int] = {}
    final = 1 + max((e.depth for e in exprs.values()), default=0)

    def visit(e: Expr, used_at: int) -> None:
        if e.window:
            last_use[e.key] = max(last_use.get(e.key, 0), used_at)
            if e.key in nodes:
                return
            nodes[e.key] = e
            used_at = e.depth
        elif e.key[0] == "measure":
            last_use[e.key] = max(last_use.get(e.key, 0), used_at)
        for a in e.args:
            visit(a, used_at)

    for e in exprs.values():
        visit(e, final)
    name = {key: f"_w{k}" for k, key in enumerate(nodes)}

    def column(e: Expr, own: bool = False) -> Column:
        if e.window and not own:
            return F.col(name[e.key])
        return e.build(*(column(a) for a in e.args))

    for level in range(1, final):
        own = [(k, e) for k, e in nodes.items() if e.depth == level]
        made = [column(e, own=True).alias(name[k]) for k, e in own if not e.series]
        inputs = {k: [f"{name[k]}_{i}" for i in range(len(e.args))] for k, e in own if e.series}
        made += [column(a).cast("double").alias(i) for k, e in own if e.series for a, i in zip(e.args, inputs[k], strict=True)]
        held = [name[k] for k, e in nodes.items() if e.depth < level and last_use[k] >= level]
        measures = [k[1] for k, at in last_use.items() if k[0] == "measure" and at >= level and k[1] not in keep]
        panel = panel.select(*keep, *measures, *held, *made)
        if inputs:
            panel = _with_series(panel, [(name[k], nodes[k].series, own) for k, own in inputs.items()], "slot" if "slot" in keep else "dt")
    return panel.select(*keep, *(column(e).alias(out) for out, e in exprs.items()))
