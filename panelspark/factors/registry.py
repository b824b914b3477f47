"""Registry of factors and the jobs over it."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.expr import Expr, evaluate, measure
from panelspark.operators import grid
from panelspark.operators.cs import finite, process
from panelspark.operators.slots import by_range, calendar_of, evaluate_on_slots
from panelspark.operators.wide import evaluate_wide


@dataclass(frozen=True)
class Factor:
    name: str
    category: str
    expr: Expr
    #: Reads values of later dates.
    lookahead: bool = False


FACTORS: dict[str, Factor] = {}


def register(category: str, exprs: dict[str, Expr], lookahead: bool = False) -> None:
    for name, expr in exprs.items():
        if name in FACTORS:
            raise ValueError(f"factor {name} is registered twice")
        FACTORS[name] = Factor(name, category, expr, lookahead)


def register_factor(category: str, name: str) -> Callable[[Callable[[], Expr]], Callable[[], Expr]]:
    """Decorator for a function that gives the expression."""
    def held(f: Callable[[], Expr]) -> Callable[[], Expr]:
        register(category, {name: f()})
        return f

    return held


def names(category: str | None = None) -> list[str]:
    return sorted(f.name for f in FACTORS.values() if category in (None, f.category))


def compute_factors(panel: DataFrame, chosen: Iterable[str], slots: bool = False, days: DataFrame | None = None) -> DataFrame:
    """entity, dt and one column for each factor: one plan, one scan, one shuffle by entity (cross sections add one by date).

    Windows count the rows of an entity; with ``slots`` they count the days of the calendar ``days`` (dt, slot), or of the
    panel, so that days without a row take a place.
    """
    chosen = list(chosen)
    exprs = {n: FACTORS[n].expr for n in chosen}
    program = None if slots and all(map(by_range, exprs.values())) else grid.program(exprs)
    if program and program.windows:
        made = evaluate_wide(panel, program, (calendar_of(panel) if days is None else days) if slots else None)
    else:
        made = evaluate_on_slots(panel, exprs, days) if slots else evaluate(panel, exprs)
    return made.withColumns({n: finite(F.col(n).cast("double")) for n in chosen})


def factor_table(panel: DataFrame, chosen: Iterable[str], path: str, keep: Iterable[str] = ("close",)) -> DataFrame:
    """The chosen factors beside measures of the panel (``keep``), written to ``path`` and read again: what a backtest reads
    several times is computed in one pass over the source."""
    chosen = list(chosen)
    made = evaluate(panel, {c: measure(c) for c in keep} | {n: FACTORS[n].expr for n in chosen})
    made.withColumns({n: finite(F.col(n).cast("double")) for n in chosen}).write.parquet(path)
    return panel.sparkSession.read.schema(made.schema).parquet(path)


def processed_factors(panel: DataFrame, chosen: Iterable[str], pct: float = 0.01) -> DataFrame:
    """compute_factors, then winsorized and standardized by date."""
    chosen = list(chosen)
    return process(compute_factors(panel, chosen), chosen, pct)


def long_form(wide: DataFrame, chosen: Iterable[str] | None = None) -> DataFrame:
    """(factor, entity, dt, value) without missing cells: the form of the factor store."""
    cols = [c for c in (chosen or wide.columns) if c not in ("entity", "dt")]
    return wide.unpivot(["entity", "dt"], cols, "factor", "value").filter("value is not null")


def export_factors(panel: DataFrame, chosen: list[str], path: str, chunk: int = 30, partition_by: str = "factor") -> None:
    """Append the chosen factors to a store partitioned by factor, dt or entity; wide families go in chunks that keep plans small."""
    for k in range(0, len(chosen), chunk):
        some = chosen[k : k + chunk]
        long_form(compute_factors(panel, some)).write.mode("append").partitionBy(partition_by).parquet(path)


def compute_all(panel: DataFrame, chosen: Iterable[str], known: dict[str, Factor] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The factors that can be planned over ``panel``, as one plan, and what is wrong with the others, by name."""
    known = FACTORS if known is None else known
    good, failed = {}, {}
    for n in chosen:
        try:
            evaluate(panel, {n: known[n].expr}).schema  # noqa: B018  analysed, not run
            good[n] = known[n].expr
        except Exception as e:  # a factor's failure is its own
            failed[n] = f"{type(e).__name__}: {e}"[:500]
    made = evaluate(panel, good)
    return made.withColumns({n: finite(F.col(n).cast("double")) for n in good}) if good else made, failed


def export_all(panel: DataFrame, chosen: Iterable[str], path: str, chunk: int = 30, partition_by: str = "factor", known: dict[str, Factor] | None = None) -> dict[str, str]:
    """Write every factor that can be computed; gives what went wrong with the others.

    A factor that cannot be planned is left out at once. Where a chunk fails while it runs, its halves are written apart, until
    the failing factor stands alone; a failed write leaves no rows.
    """
    made, failed = compute_all(panel, list(chosen), known)
    todo = [n for n in made.columns if n not in ("entity", "dt")]
    groups = [todo[k : k + chunk] for k in range(0, len(todo), chunk)]
    while groups:
        some = groups.pop(0)
        own, _ = compute_all(panel, some, known)
        try:
            long_form(own).write.mode("append").partitionBy(partition_by).parquet(path)
        except Exception as e:  # a factor's failure is its own
            if len(some) == 1:
                failed[some[0]] = f"{type(e).__name__}: {e}"[:500]
            else:
                groups[:0] = [some[: len(some) // 2], some[len(some) // 2 :]]
    return failed
