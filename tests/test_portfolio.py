"""Figures of a book with days without a return and a value below zero, against the SQL of the queries."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from panelspark import queries
from panelspark.portfolio import analysis, backtest

RETURNS = {"gaps": [None, 0.02, -0.01, None, 0.03, -0.05, None], "below zero": [0.1, -1.5, None, 0.2, -0.1, 0.3, 0.1, -0.2], "whole": [0.01, -0.02, 0.03, 0.01, -0.01]}
ROWS = [(f, dt.date(2024, 1, 1) + dt.timedelta(days=k), r) for f, own in RETURNS.items() for k, r in enumerate(own)]
CAPITALS = (1e6, 1e7, 1e8)
COMPUTED = {
    "portfolio_metrics": backtest.metrics,
    "portfolio_tear_sheet": analysis.tear_sheet,
    "portfolio_capacity": lambda book: analysis.capacity(backtest.metrics(book), list(CAPITALS)),
}


def _sql(name: str) -> str:
    """The query's SQL with the rows above in place of its book of returns."""
    rows = ", ".join(f"('{f}', DATE '{d}', {'NULL' if r is None else r}::DOUBLE)" for f, d, r in ROWS)
    return f"WITH small AS (SELECT * FROM (VALUES {rows}) t(factor, dt, ret)), nav AS {queries.SQL[name].split(', nav AS ', 1)[1]}"


@pytest.mark.parametrize("name", COMPUTED)
def test_days_without_a_return(spark, name):
    book = spark.createDataFrame(ROWS, "factor string, dt date, ls_ret double")
    got = queries.rounded(COMPUTED[name](book))
    want = duckdb.connect().sql(_sql(name))
    assert sorted(got.columns) == sorted(want.columns)
    key = lambda row: (row["factor"], row.get("capital", 0))
    got = sorted((r.asDict() for r in got.collect()), key=key)
    want = sorted((dict(zip(want.columns, r, strict=True)) for r in want.fetchall()), key=key)
    assert len(got) == len(want) and any(isinstance(v, float) and math.isnan(v) for r in want for v in r.values())
    for a, b in zip(got, want, strict=True):
        assert all(a[c] == b[c] or a[c] == pytest.approx(b[c], abs=2e-6, nan_ok=True) for c in b), (a, b)
