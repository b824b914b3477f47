"""Expressions in numpy against the windows of Spark, on series of several lengths with gaps."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.expr import evaluate, measure
from panelspark.factors import alpha158, formulaic, registry, technical  # noqa: F401  importing registers them
from panelspark.operators import cs, grid, slots, ts, wide

SF = "/root/testdata/sf0.001"
SLOTS_ALPHAS = ["alpha001", "alpha005", "alpha012", "alpha017", "alpha026", "alpha027", "alpha035", "alpha053", "alpha060", "alpha101"]
FAMILIES = {
    "formulaic_029_042": sorted(formulaic.ALPHAS)[28:42],
    "alpha158_rolling_60": registry.names("alpha158_rolling_60"),
    "alpha158_rolling_10": registry.names("alpha158_rolling_10"),
    "alpha158_rolling_20": registry.names("alpha158_rolling_20"),
    "alpha158_rolling_30": registry.names("alpha158_rolling_30"),
    "factors_rolling": registry.names("rolling"),
    "formulaic_001_014": sorted(formulaic.ALPHAS)[0:14],
    "formulaic_043_060": sorted(formulaic.ALPHAS)[42:56],
    "formulaic_015_028": sorted(formulaic.ALPHAS)[14:28],
    "formulaic_061_081": sorted(formulaic.ALPHAS)[56:70],
    "formulaic_083_101": sorted(formulaic.ALPHAS)[70:84],
}
SLOTTED: dict[str, list[str]] = {
    "slots_alpha158_20": registry.names("alpha158_rolling_20"),
    "slots_formulaic": SLOTS_ALPHAS,
}


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(5)
    rows = []
    for entity, days in (("a", 150), (None, 3), ("b", 90), ("c", 1), ("d", 149)):
        for d in np.sort(rng.permutation(160)[:days]):
            o, h, l, c, v, w = (None if rng.random() < 0.05 else float(rng.integers(1, 40)) for _ in range(6))
            rows.append((entity, int(d), o, h, l, c, v, None if v is None else v * 7, w))
    made = spark.createDataFrame(rows, "entity string, day int, open double, high double, low double, close double, volume double, amount double, vwap double")
    return made.selectExpr("entity", "date_add(DATE '2024-01-01', day) AS dt", "open", "high", "low", "close", "volume", "amount", "vwap").repartition(3).cache()


def _rows(df):
    return {(r["entity"], r["dt"]): [None if v is None or v != v else v for v in tuple(r)[2:]] for r in df.collect()}


def _same(got, want):
    names, got, want = want.columns[2:], _rows(got), _rows(want)
    assert got.keys() == want.keys()
    for key, row in want.items():
        off = [(n, a, b) for n, a, b in zip(names, got[key], row, strict=True) if (a is None) != (b is None) or (a is not None and not math.isclose(a, b, rel_tol=1e-7, abs_tol=1e-8))]
        assert not off, (key, off)


def test_equal_to_windows(panel, monkeypatch):
    """Each rule by itself, with blocks of few entities."""
    monkeypatch.setattr(wide, "CELLS", 300)
    x, y, v = map(measure, ("close", "open", "volume"))
    exprs = {f"{f.__name__} {n}": f(x, n) for f in (ts.ref, ts.mean, ts.total, ts.std, ts.highest, ts.lowest, ts.product, ts.ts_rank, ts.argmax, ts.argmin, ts.decay_linear) for n in (1, 2, 7)}
    exprs |= {"corr": ts.corr(x, y, 9), "cov": ts.cov(x, v, 4), "quantile": ts.quantile(x, 6, 0.3), "rank": ts.rank_whole(x), "scale": ts.scale_whole(x - y), "fill": ts.fill_forward(x, 2), "back": ts.fill_backward(x), "long": ts.mean(x, 400, 1)}
    exprs |= {"date": cs.rank_pct(ts.mean(x, 3)) * 2, "row": ts.or_else(ts.when(x > y, ts.log(x), -ts.sqrt(y)), 0.5) ** 2, "constant": ts.std(ts.or_else(x * 0.0, 0.0) + 0.1, 5)}
    program = grid.program(exprs)
    _same(wide.evaluate_wide(panel, program), evaluate(panel, exprs))
    filled = panel.filter("entity is not null")
    _same(wide.evaluate_wide(filled, program, slots.calendar_of(filled)), slots.evaluate_on_slots(filled, exprs))


def test_what_has_no_rule():
    x = measure("close")
    assert grid.program({"a": ts.ewm(x, 5)}) is None and grid.program({"a": ts.mean(cs.rank_pct(x), 3)}) is None


@pytest.mark.parametrize("name", FAMILIES)
def test_family(panel, name):
    """Equal, with whole series in one step instead of a sort for each rank and a stage for each level of windows."""
    names = FAMILIES[name]
    exprs = {n: registry.FACTORS[n].expr for n in names}
    got = registry.compute_factors(panel, names)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Window ") <= 4
    _same(got.select("entity", "dt", *(F.round(n, 8).alias(n) for n in names)), evaluate(panel, exprs).select("entity", "dt", *(F.round(cs.finite(F.col(n).cast("double")), 8).alias(n) for n in names)))


@pytest.mark.parametrize("name", SLOTTED)
def test_family_on_slots(panel, name):
    """No row is made for a day on which an entity has none."""
    names = SLOTTED[name]
    own = panel.filter("entity is not null")
    got = registry.compute_factors(own, names, slots=True)
    assert "explode" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = slots.evaluate_on_slots(own, {n: registry.FACTORS[n].expr for n in names})
    _same(got.select("entity", "dt", *(F.round(n, 8).alias(n) for n in names)), want.select("entity", "dt", *(F.round(cs.finite(F.col(n).cast("double")), 8).alias(n) for n in names)))


def test_bars_are_shuffled_once(spark):
    plan = registry.compute_factors(tm.bars_weekly(spark, SF), ["ma_dev_20d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
