"""Registered queries of windows over trading days, pooled and rolling ranks, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.factors import formulaic, registry
from panelspark.queries import _RET, CLASSIC_MOMENTUM, alphas, compiled_sql, panel_sql, query, roll, rolling_158, rounded

# ---- windows over trading days: the bars of single days have gaps ---------------------------------------------------------------

#: All entities on all dates; the bars' columns are missing where there is no bar.
GRID_SQL = f"""
SELECT e.entity, d.dt, open, high, low, close, volume, amount, vwap
FROM (SELECT DISTINCT l_suppkey AS entity FROM lineitem WHERE l_quantity > 0) e CROSS JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem WHERE l_quantity > 0) d
LEFT JOIN ({tm.DAILY_SQL}) b ON b.entity = e.entity AND b.dt = d.dt
"""


def on_slots(names: list[str], made=lambda df: df):
    return lambda spark, sf_dir: rounded(made(registry.compute_factors(tm.bars_daily(spark, sf_dir), names, slots=True)))


def own_rows(sql: str) -> str:
    """The rows of the grid that have a bar, after all windows: ``sql`` selects entity, dt and more from a panel."""
    return f"SELECT * EXCLUDE (own_close) FROM ({sql.replace('SELECT entity, dt, ', 'SELECT entity, dt, close AS own_close, ', 1)}) WHERE own_close IS NOT NULL"


_SLOT_MOMENTUM = CLASSIC_MOMENTUM | {"vol_1m": f"{roll('stddev_samp', 'ret', 21, 10)} * sqrt(252)", "downside_vol_1m": f"{roll('stddev_samp', 'CASE WHEN ret > 0 THEN 0 ELSE ret END', 21, 10)} * sqrt(252)", "vol_3m": f"{roll('stddev_samp', 'ret', 63, 30)} * sqrt(252)"}
query("slots_classic", own_rows(panel_sql(_SLOT_MOMENTUM, GRID_SQL, _RET)))(on_slots(sorted(_SLOT_MOMENTUM)))

_COLUMNS, _STEPS = rolling_158(20)
query("slots_alpha158_20", own_rows(panel_sql(_COLUMNS, GRID_SQL, _STEPS)))(on_slots(sorted(_COLUMNS)))

#: Formulas with ranks, places, products, correlations and weighted means.
_SLOT_ALPHAS = ["alpha001", "alpha005", "alpha012", "alpha017", "alpha026", "alpha027", "alpha035", "alpha053", "alpha060", "alpha101"]
_single = lambda df: df.select("entity", "dt", *(F.when(F.abs(n) < 3e38, F.col(n).cast("float").cast("double")).alias(n) for n in _SLOT_ALPHAS))
query("slots_formulaic", own_rows(compiled_sql(_SLOT_ALPHAS, GRID_SQL)))(on_slots(_SLOT_ALPHAS, _single))
