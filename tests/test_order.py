"""Rolling order statistics against a value by value count."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from panelspark.expr import evaluate, measure
from panelspark.operators import order, ts


@pytest.mark.parametrize("n", [1, 2, 5, 63, 64, 65, 130, 252, 5000])
@pytest.mark.parametrize("m", [0, 1, 64, 127, 500])
def test_counts(n, m):
    rng = np.random.default_rng(n + m)
    x = rng.integers(0, 20, m).astype(float)
    x[rng.random(m) < 0.2] = np.nan
    less, same, present = order.counts_in_window(x, n)
    for i in range(m):
        w = x[max(0, i - n + 1) : i + 1]
        assert present[i] == (~np.isnan(w)).sum()
        if not np.isnan(x[i]):
            assert (less[i], same[i]) == ((w < x[i]).sum(), (w == x[i]).sum())


def test_ranks_of_a_panel(spark):
    rng = np.random.default_rng(2)
    rows = [(e, int(d), None if rng.random() < 0.1 else float(rng.integers(0, 30))) for e in (1, 2, 3) for d in rng.permutation(200)]
    panel = spark.createDataFrame(rows, "entity int, day int, x double").selectExpr("entity", "date_add(DATE '2024-01-01', day) AS dt", "x")
    exprs = {"short": ts.ts_rank(measure("x"), 10), "long": ts.ts_rank(measure("x"), 100, 20), "share": ts.pct_rank_rolling(measure("x"), 90, 30), "later": ts.mean(ts.ts_rank(measure("x"), 70), 3, 1)}
    got = evaluate(panel, exprs).orderBy("entity", "dt").toPandas()
    frame = panel.orderBy("entity", "dt").toPandas()
    for _, own in frame.groupby("entity"):
        x, mine = own["x"], got.loc[own.index]
        want = {"short": x.rolling(10, min_periods=1).rank(), "long": x.rolling(100, min_periods=20).rank(), "share": x.rolling(90, min_periods=30).rank(pct=True) * 100, "later": x.rolling(70, min_periods=1).rank().rolling(3, min_periods=1).mean()}
        for name, w in want.items():
            pd.testing.assert_series_equal(mine[name], w, check_names=False)
