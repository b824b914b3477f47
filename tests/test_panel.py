"""Golden mini-panels: one entity with six dates, and small cross sections."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from panelspark.expr import evaluate, measure
from panelspark.operators import cs, ts

X = [10.0, 11.0, None, 13.0, 12.0, 15.0]
Y = [1.0, 2.0, 4.0, 3.0, 7.0, 5.0]
V = [5.0, 3.0, 4.0, 4.0, 6.0, 2.0]
N = None
DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [("a", DAY + dt.timedelta(days=k), *v) for k, v in enumerate(zip(X, Y, V, strict=True))]
    other = [("b", DAY + dt.timedelta(days=k), 100.0 * k, -1.0 * k, 7.0) for k in range(6)]
    return spark.createDataFrame(rows + other, "entity string, dt date, x double, y double, v double").repartition(3)


def values(panel, expr):
    rows = evaluate(panel, {"out": expr}).filter("entity = 'a'").orderBy("dt").collect()
    return [r["out"] for r in rows]


x, y, v = measure("x"), measure("y"), measure("v")
GOLDEN = {
    "lag": (ts.ref(x, 2), [N, N, 10, 11, N, 13]),
    "lag back": (ts.ref(x, -2), [N, N, 10, 11, N, 13]),
    "delta": (ts.delta(x, 1), [N, 1, N, N, -1, 3]),
    "mean": (ts.mean(x, 3, 1), [10, 10.5, 10.5, 12, 12.5, 13.333333]),
    "mean of full windows": (ts.mean(x, 3, 3), [N, N, N, N, N, 13.333333]),
    "std": (ts.std(x, 3, 1), [N, 0.707107, 0.707107, 1.414214, 0.707107, 1.527525]),
    "skew": (ts.skew_own(y, 4), [N, N, 0.666993, 0.755949, 0.790575, 1.594522]),
    "corr": (ts.corr_own(y, v, 4), [N, N, -0.081832, -0.118585, 0.436862, 0.425800]),
    "ewm": (ts.ewm(y, 3), [N, N, 3, 3, 5.064516, 5.031746]),
    "rsi": (ts.rsi(y, 3), [N, N, N, 55.555556, 90.243902, 50.684932]),
    "ts_rank": (ts.ts_rank(y, 3), [1, 2, 3, 2, 3, 2]),
    "argmax": (ts.argmax(y, 3), [1, 2, 3, 2, 3, 2]),
    "decay": (ts.decay_linear(x, 3), [10, 11, 10.833333, 12, 12.166667, 13.666667]),
    "pct rank": (ts.pct_rank_rolling(y, 4, 2), [N, 100, 100, 75, 100, 75]),
}


@pytest.mark.parametrize("name", GOLDEN)
def test_golden(panel, name):
    expr, want = GOLDEN[name]
    got = values(panel, expr)
    assert [None if g is None else round(g, 5) for g in got] == [None if w is None else pytest.approx(w, abs=2e-5) for w in want]


def test_rank_whole(spark):
    rows = [("a", DAY + dt.timedelta(days=k), z) for k, z in enumerate([3.0, 1.0, None, 3.0, 2.0])]
    got = values(spark.createDataFrame(rows, "entity string, dt date, x double"), ts.rank_whole(x))
    assert got == [0.875, 0.25, None, 0.875, 0.5]


def test_ewm_over_many_blocks_matches_the_recursion(spark):
    n = 900
    series = [math.sin(k) * 10 + k % 7 for k in range(n)]
    rows = [("a", DAY + dt.timedelta(days=k), z if k % 11 else None) for k, z in enumerate(series)]
    got = values(spark.createDataFrame(rows, "entity string, dt date, x double"), ts.ewm(x, 3, 1))
    num = den = 0.0
    for k in range(n):
        num, den = num * 0.5, den * 0.5
        if k % 11:
            num, den = num + series[k], den + 1
            assert got[k] == pytest.approx(num / den, rel=1e-9)
        else:
            assert got[k] is None


def test_equal_parts_are_one_column(panel):
    plan = evaluate(panel, {"a": ts.mean(y, 3) / y, "b": ts.mean(y, 3) * 2, "c": ts.mean(ts.mean(y, 3), 2)})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("avg(y") == 1
    assert plan.columns == ["entity", "dt", "a", "b", "c"]


def test_winsorize_and_standardize(spark):
    rows = [(e, DAY, z) for e, z in zip("abcd", (1.0, 2.0, 3.0, 100.0), strict=True)]
    df = spark.createDataFrame(rows, "entity string, dt date, f double")
    got = {r["entity"]: r["f"] for r in cs.process(df, ["f"]).collect()}
    want = {"a": -0.520540, "b": -0.500139, "c": -0.479107, "d": 1.499785}
    assert got == {k: pytest.approx(z, abs=1e-6) for k, z in want.items()}
    flat = spark.createDataFrame([("a", DAY, 5.0), ("b", DAY, 5.0), ("c", DAY, None)], "entity string, dt date, f double")
    assert {r["f"] for r in cs.standardize(flat, ["f"]).collect()} == {0.0}


def test_neutralise_equals_least_squares(spark):
    cap = [10, 11, 12, 10, 13, 12]
    rows = [(e, DAY, f, float(c), i) for e, f, c, i in zip("abcdef", (1.0, 2.0, 4.0, 3.0, 5.0, 7.0), (math.exp(c) for c in cap), "xxxyyy", strict=True)]
    df = spark.createDataFrame(rows, "entity string, dt date, f double, cap double, industry string")
    got = [r["f"] for r in cs.neutralise(df, "f", "cap", "industry", least=1).orderBy("entity").collect()]
    assert got == [pytest.approx(z, abs=1e-6) for z in (-1.272317, -0.499549, 1.273219, -1.621280, -0.302976, 1.924256)]
    same = [r["f"] for r in cs.neutralise(df, "f", "cap", "industry").orderBy("entity").collect()]
    assert same == [1, 2, 4, 3, 5, 7]


def test_densify(spark):
    rows = [("a", DAY, 1.0), ("a", DAY + dt.timedelta(days=2), 3.0), ("b", DAY + dt.timedelta(days=1), 2.0)]
    df = spark.createDataFrame(rows, "entity string, dt date, x double")
    assert cs.densify(df).count() == 4
    assert cs.densify(df, whole_range=True).count() == 6


def test_an_entity_does_not_change_another(panel):
    alone = [r["o"] for r in evaluate(panel.filter("entity = 'a'"), {"o": ts.ewm(y, 3)}).orderBy("dt").collect()]
    assert alone == values(panel, ts.ewm(y, 3))
