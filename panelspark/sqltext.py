"""DuckDB SQL of panel expressions: an account of every operator apart from the Spark code, for the correctness oracle.

Each node of an expression tree is written by the rule of its operator below, not by running it through Spark. Windows that
read other windows become stages (common table expressions) of plain columns.
"""

from __future__ import annotations

from panelspark.expr import Expr

_ORDER = "PARTITION BY entity ORDER BY dt"
_ALL = "PARTITION BY entity"


def _frame(n: int) -> str:
    return f"({_ORDER} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


#: Functions of one row; arguments are SQL.
ROW_RULES = {
    "add": lambda a, b: f"({a} + {b})",
    "sub": lambda a, b: f"({a} - {b})",
    "mul": lambda a, b: f"({a} * {b})",
    "div": lambda a, b: f"({a} / nullif({b}, 0))",
    "pow": lambda a, b: f"pow({a}, {b})",
    "neg": lambda a: f"(-{a})",
    "lt": lambda a, b: f"coalesce({a} < {b}, false)",
    "le": lambda a, b: f"coalesce({a} <= {b}, false)",
    "gt": lambda a, b: f"coalesce({a} > {b}, false)",
    "ge": lambda a, b: f"coalesce({a} >= {b}, false)",
    "and": lambda a, b: f"({a} AND {b})",
    "or": lambda a, b: f"({a} OR {b})",
    "not": lambda a: f"(NOT {a})",
    "when": lambda t, a: f"(CASE WHEN {t} THEN {a} END)",
    "when else": lambda t, a, b: f"(CASE WHEN {t} THEN {a} ELSE {b} END)",
    "where both": lambda a, b: f"(CASE WHEN {b} IS NOT NULL THEN {a} END)",
    "larger": lambda a, b: f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN greatest({a}, {b}) END)",
    "smaller": lambda a, b: f"(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN least({a}, {b}) END)",
    "log": lambda a: f"(CASE WHEN {a} > 0 THEN ln({a}) END)",
    "abs": lambda a: f"abs({a})",
    "sign": lambda a: f"sign({a})",
    "sqrt": lambda a: f"(CASE WHEN {a} >= 0 THEN sqrt({a}) END)",
    "positive": lambda a: f"(CASE WHEN {a} > 0 THEN {a} END)",
    "not zero": lambda a: f"nullif({a}, 0)",
    "single": lambda a: f"try_cast(round({a}, 10) AS FLOAT)::DOUBLE",
    "zero": lambda a: f"coalesce({a}, 0)",
}
ROLLING_RULES = {"mean": "avg({})", "sum": "sum({})", "std": "stddev_samp({})", "max": "max({})", "min": "min({})", "product": "product({})", "cov": "covar_samp({}, {})", "count": "count({})"}
_LIST = {"argmax": "list_max", "argmin": "list_min"}


def _window(key, args: list[str]) -> str:
    """A window function over plain columns."""
    name, *rest = key if isinstance(key, tuple) else (key,)
    x = args[0] if args else ""
    if name == "ref":
        return f"lag({x}, {rest[0]}) OVER ({_ORDER})"
    if name == "row":
        return f"row_number() OVER ({_ORDER})"
    if name == "fill":
        return f"last_value({x} IGNORE NULLS) OVER ({_ORDER} ROWS BETWEEN {'UNBOUNDED' if rest[0] is None else rest[0]} PRECEDING AND CURRENT ROW)"
    if name == "fill back":
        return f"first_value({x} IGNORE NULLS) OVER ({_ORDER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    if name == "rank whole":
        return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER ({_ALL} ORDER BY {x} NULLS LAST) + (count(*) OVER ({_ALL}, {x}) - 1) / 2) / count({x}) OVER ({_ALL}) END"
    if name == "sum abs":
        return f"sum(abs({x})) OVER ({_ALL})"
    if name == "held":
        return f"list({x}) OVER {_frame(rest[0])}"
    n, least = rest
    if name == "ts_rank":
        seen = f"list({x}) OVER {_frame(n)}"
        return f"CASE WHEN {x} IS NOT NULL AND count({x}) OVER {_frame(n)} >= {least} THEN len(list_filter({seen}, lambda v: v < {x})) + (len(list_filter({seen}, lambda v: v = {x})) + 1) / 2 END"
    if name in _LIST:
        held, count = args
        return f"CASE WHEN {count} >= {least} THEN list_position({held}, {_LIST[name]}({held}))::DOUBLE END"
    enough = f"count(CASE WHEN {' AND '.join(f'{a} IS NOT NULL' for a in args)} THEN 1 END) OVER {_frame(n)} >= {least}"
    return f"CASE WHEN {enough} THEN {ROLLING_RULES[name].format(*args)} OVER {_frame(n)} END"


def panel_sql(bars: str, exprs: dict[str, Expr]) -> tuple[str, dict[str, str]]:
    """A chain of common table expressions over ``bars`` (SQL), whose last is ``panel``, and the SQL of each output over it."""
    windows: dict[tuple, Expr] = {}

    def visit(e: Expr) -> None:
        if e.key in seen:
            return
        seen.add(e.key)
        for a in e.args:
            visit(a)
        if e.window:
            windows[e.key] = e

    seen: set[tuple] = set()
    for e in exprs.values():
        visit(e)
    column = {key: f"w{k}" for k, key in enumerate(windows)}

    def text(e: Expr) -> str:
        name = e.key[0]
        if e.window:
            return column[e.key]
        if name == "measure":
            return e.key[1]
        if name == "literal":
            return f"({e.key[1]!r}::DOUBLE)"
        args = [text(a) for a in e.args]
        if isinstance(name, tuple) and name[0] == "or":
            return f"coalesce({args[0]}, {name[1]!r})"
        return ROW_RULES[name](*args)

    steps, last = [f"panel0 AS MATERIALIZED (SELECT * FROM ({bars}))"], "panel0"
    for depth in range(1, 1 + max((e.depth for e in windows.values()), default=0)):
        own = [e for e in windows.values() if e.depth == depth]
        inputs: dict[str, str] = {}
        for e in own:
            for a in e.args:
                inputs.setdefault(text(a), f"a{depth}_{len(inputs)}")
        made = ", ".join(f"{_window(e.key[0], [inputs[text(a)] for a in e.args])} AS {column[e.key]}" for e in own)
        drop = f"EXCLUDE ({', '.join(inputs.values())})" if inputs else ""
        before = ", ".join(["*", *(f"{x} AS {name}" for x, name in inputs.items())])
        steps.append(f"panel{depth} AS MATERIALIZED (SELECT * {drop}, {made} FROM (SELECT {before} FROM {last}))")
        last = f"panel{depth}"
    steps.append(f"panel AS (SELECT * FROM {last})")
    return ",\n ".join(steps), {name: text(e) for name, e in exprs.items()}
