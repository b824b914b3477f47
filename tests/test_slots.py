"""Windows over trading days against the dense grid, on bars with gaps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.factors import alpha158, classic, formulaic, registry  # noqa: F401  importing registers them
from panelspark.operators import cs, slots

SF = "/root/testdata/sf0.001"
RANGED = ["ret_1m", "ret_12m_1m", "max_ret_1m", "vol_1m", "vol_3m", "skew_1m", "turnover_1m", "turnover_cv", "amihud_illiq", "ma_dev_20d", "STD20"]
GRIDDED = ["earnings_stability", "roe_ttm", "QTLU20", "IMAX20", "RANK20", "BETA20", "WVMA20", "alpha001", "alpha017", "alpha035", "alpha053", "rsi_14"]


@pytest.fixture(scope="module")
def bars(spark):
    """Of a few suppliers, with columns that other families read."""
    made = tm.bars_daily(spark, SF).filter("entity <= 4 and dt < '1996-09-01'")
    return made.select("*", F.col("amount").alias("total_mv"), (F.col("volume") / 50).alias("turnover_rate"), (F.col("close") / 100).alias("roe")).cache()


def _rows(df, names):
    key = df.select("entity", F.col("dt").cast("string").alias("dt"), *(F.round(F.col(n), 6).alias(n) for n in names))
    return {(r["entity"], r["dt"]): tuple(r)[2:] for r in key.collect()}


@pytest.mark.parametrize("names", [RANGED, GRIDDED], ids=["range", "grid"])
def test_equal_to_the_dense_grid(bars, names):
    from panelspark.factors import technical  # noqa: F401

    grid = cs.densify(bars, whole_range=True)
    want = _rows(registry.compute_factors(grid, names).join(bars.select("entity", "dt"), ["entity", "dt"], "left_semi"), names)
    got = _rows(registry.compute_factors(bars, names, slots=True), names)
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, abs=2e-6), (key, dict(zip(names, zip(got[key], row, strict=True), strict=True)))
    rows_mode = _rows(registry.compute_factors(bars, names), names)
    assert any(rows_mode[k] != got[k] for k in got)


def test_ranges_need_no_rows_of_other_days(bars):
    assert all(slots.by_range(registry.FACTORS[n].expr) for n in RANGED) and sum(slots.by_range(registry.FACTORS[n].expr) for n in GRIDDED) < 4
    plan = registry.compute_factors(bars, RANGED, slots=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan and "specifiedwindowframe(RangeFrame" in plan


def test_a_calendar_of_its_own(spark, bars):
    """Days on which nobody trades take places as well."""
    days = spark.sql("SELECT explode(sequence(DATE '1995-01-01', DATE '1996-12-31')) AS dt")
    days = slots.calendar_of(days)
    one = spark.createDataFrame([(1, f"1995-03-{d:02d}", float(d)) for d in (1, 2, 5, 6)], "entity long, dt string, close double").withColumn("dt", F.to_date("dt"))
    got = registry.compute_factors(one, ["ret_1d"], slots=True, days=days).orderBy("dt").collect()
    assert [r["ret_1d"] for r in got] == [None, pytest.approx(0.5 - 1), None, pytest.approx(5 / 6 - 1)]
