"""Windows over trading days instead of an entity's own rows: a day on which an entity has no row takes a place in its windows.

A ``slot`` is the ordinal of a date in the calendar. Where all windows of an expression are rolling aggregates and shifts of
values that only exist where there is a row, they run as RANGE frames over the slot and no row is added. Other expressions
(windows of windows, places in a window, weighted means) also need what the windows give on the days between: for them the
missing days are added inside the partition of the entity, by the shuffle that the windows need anyway, and left out at
the end. Both equal the dense grid of all entities and dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.expr import Expr, evaluate
from panelspark.operators import ts

#: Functions of a row that are missing where one of their arguments is.
_STRICT = {"add", "sub", "mul", "div", "pow", "neg", "log", "abs", "sign", "sqrt", "positive", "not zero", "larger", "smaller", "single", "own", "other"}


def only_on_rows(e: Expr) -> bool:
    """Whether the value is missing wherever all measures are."""
    name = e.key[0]
    if name == "measure":
        return True
    if e.window:
        return False
    if name in _STRICT:
        return any(map(only_on_rows, e.args))
    if name == "where both":
        return only_on_rows(e.args[0])
    if name in ("when", "when else"):
        return all(map(only_on_rows, e.args[1:]))
    return False


def by_range(e: Expr) -> bool:
    """Whether RANGE frames over the slots give what the dense grid gives."""
    if e.window and not (ts.ranged(e) and all(map(only_on_rows, e.args))):
        return False
    return all(map(by_range, e.args))


def calendar_of(panel: DataFrame) -> DataFrame:
    """(dt, slot): the dates of a panel, numbered from 1; as many rows as there are dates."""
    return panel.select("dt").distinct().select("dt", F.row_number().over(Window.orderBy("dt")).alias("slot"))


def with_missing_days(panel: DataFrame, days: DataFrame) -> DataFrame:
    """``panel`` (with slots) and a row for every day of the calendar that an entity lacks; ``_here`` tells its own rows."""
    measures = [c for c in panel.columns if c not in ("entity", "dt", "slot")]
    w = Window.partitionBy("entity").orderBy("slot")
    # The calendar's length grows with the number of trading days only.
    end = days.agg(F.max("slot")).scalar()
    reach = panel.select("*", F.coalesce(F.lag("slot").over(w), F.lit(0)).alias("_before"), F.lead("slot").over(w).alias("_next"))
    cells = reach.withColumn("_last", F.coalesce(F.col("slot"), F.col("_before"))).withColumn("_to", F.when(F.col("_next").isNull(), end).otherwise(F.col("slot")))
    cells = cells.withColumn("_slot", F.explode(F.sequence(F.col("_before") + 1, F.col("_to"))))
    here = F.col("_slot") == F.col("slot")
    return cells.select("entity", F.when(here, F.col("dt")).alias("dt"), F.col("_slot").alias("slot"), *(F.when(here, F.col(c)).alias(c) for c in measures), here.alias("_here"))


def evaluate_on_slots(panel: DataFrame, exprs: dict[str, Expr], days: DataFrame | None = None) -> DataFrame:
    """``evaluate`` with windows over the days of a calendar (dt, slot), by default the panel's own; rows of other days stay out.

    An entity has at most one row a day. Cross sections take the values of a day of all entities, also of those without a row.
    """
    days = calendar_of(panel) if days is None else days
    placed = panel.join(days, "dt")
    if all(map(by_range, exprs.values())):
        with ts.by_slots():
            return evaluate(placed, exprs, keep=("entity", "dt", "slot")).drop("slot")
    # The days between have no date yet: cross sections go by the slot.
    grid = with_missing_days(placed, days)
    with ts.in_slots():
        made = evaluate(grid, exprs, keep=("entity", "dt", "slot", "_here"))
    return made.filter("_here").drop("_here", "slot")
