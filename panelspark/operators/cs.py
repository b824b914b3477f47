"""Cross-section operators: over the entities of a date (expressions), and preparation of factor columns (DataFrames)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.expr import Expr, as_expr, windowed
from panelspark.operators import ts


def date(*more: Column):
    return Window.partitionBy(ts.day(), *more)


def rank_ordinal(x) -> Expr:
    """Place from 1 in ascending order over the number of values of the date; ties by entity."""
    def build(c: Column) -> Column:
        return F.when(c.isNotNull(), F.row_number().over(date().orderBy(c.asc_nulls_last(), "entity")) / F.count(c).over(date()))

    return windowed("rank ordinal", build, x)


def rank_pct(x) -> Expr:
    """Share of the average rank among the values of the date."""
    def build(c: Column) -> Column:
        rank = F.rank().over(date().orderBy(c.asc_nulls_last()))
        return F.when(c.isNotNull(), (rank + (F.count(F.lit(1)).over(date(c)) - 1) / 2) / F.count(c).over(date()))

    return windowed("rank pct", build, x)


def scale(x) -> Expr:
    """z-score of the date."""
    x = as_expr(x)
    return (x - windowed("date mean", lambda c: F.avg(c).over(date()), x)) / windowed("date std", lambda c: F.stddev_samp(c).over(date()), x)


def finite(c: Column) -> Column:
    """Missing for NaN and both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def winsorize(df: DataFrame, names: list[str], pct: float = 0.01) -> DataFrame:
    """Each column clipped to its exact [pct, 1 - pct] quantiles of the date."""
    bounds = [F.percentile(n, F.array(F.lit(pct), F.lit(1 - pct))).over(date()).alias(f"_q_{n}") for n in names]
    held = df.select("*", *bounds)
    clipped = {n: F.when(F.col(n).isNotNull(), F.greatest(F.least(F.col(n), F.col(f"_q_{n}")[1]), F.col(f"_q_{n}")[0])) for n in names}
    return held.withColumns(clipped).drop(*(f"_q_{n}" for n in names))


def standardize(df: DataFrame, names: list[str]) -> DataFrame:
    """z-scores of the date; where a date has no spread all its cells are 0, missing ones too."""
    moments = [F.struct(F.avg(n).over(date()).alias("m"), F.stddev_samp(n).over(date()).alias("s")).alias(f"_z_{n}") for n in names]
    held = df.select("*", *moments)
    z = {n: F.when(F.coalesce(F.col(f"_z_{n}.s"), F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.try_divide(F.col(n) - F.col(f"_z_{n}.m"), F.col(f"_z_{n}.s"))) for n in names}
    return held.withColumns(z).drop(*(f"_z_{n}" for n in names))


def process(df: DataFrame, names: list[str], pct: float = 0.01) -> DataFrame:
    """winsorize, then standardize: two stages over one shuffle by date."""
    return standardize(winsorize(df.withColumns({n: finite(F.col(n)) for n in names}), names, pct), names)


def neutralise(df: DataFrame, factor: str, cap: str | None = None, industry: str | None = None, least: int = 30) -> DataFrame:
    """Residual of the factor on log cap and industry dummies (first industry dropped, no intercept), by date.

    Closed form: within industries other than the first both sides are demeaned, which takes the dummies out; the slope on
    log cap is then one ratio of sums. Rows with a missing input, and dates with fewer than ``least`` complete rows, keep
    their value.
    """
    y, m = F.col(factor), F.log(F.when(F.col(cap) > 0, F.col(cap))) if cap else F.lit(0.0)
    full = y.isNotNull() & m.isNotNull() & (F.col(industry).isNotNull() if industry else F.lit(True))
    base = df.withColumn("_full", full).withColumn("_y", F.when(full, y)).withColumn("_m", F.when(full, m))
    base = base.withColumn("_n", F.count("_y").over(date()))
    if industry:
        base = base.withColumn("_first", F.min(F.when(F.col("_full"), F.col(industry))).over(date()))
        group = Window.partitionBy("dt", industry)
        for c in ("_y", "_m"):
            base = base.withColumn(c, F.when(F.col(industry) == F.col("_first"), F.col(c)).otherwise(F.col(c) - F.avg(c).over(group)))
    beta = F.coalesce(F.try_divide(F.sum(F.col("_y") * F.col("_m")).over(date()), F.sum(F.col("_m") * F.col("_m")).over(date())), F.lit(0.0))
    out = base.withColumn("_beta", beta)
    fitted = F.when(F.col("_full") & (F.col("_n") >= least), F.col("_y") - F.col("_beta") * F.col("_m")).otherwise(y)
    return out.withColumn(factor, fitted).select(*df.columns)


def densify(panel: DataFrame, whole_range: bool = False) -> DataFrame:
    """Every (entity, date) of the panel's dates, from the entity's first to its last date (or all dates); new cells are missing."""
    dates = panel.select("dt").distinct()
    spans = panel.groupBy("entity").agg(F.min("dt").alias("_from"), F.max("dt").alias("_to"))
    if whole_range:
        spans = spans.withColumn("_from", F.lit("0001-01-01").cast("date")).withColumn("_to", F.lit("9999-12-31").cast("date"))
    # The calendar is one array, a scalar subquery: it grows with the number of trading days only.
    days = dates.agg(F.array_sort(F.collect_set("dt"))).scalar()
    cells = spans.select("entity", "_from", "_to", days.alias("_days")).select("entity", F.explode(F.filter("_days", lambda d: (d >= F.col("_from")) & (d <= F.col("_to")))).alias("dt"))
    return cells.join(panel, ["entity", "dt"], "left")


def align(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both panels that share entity and date."""
    return a.join(b, ["entity", "dt"])
