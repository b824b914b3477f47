"""Registered queries of the panel engine and, apart from the Spark code, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import sqltext
from panelspark import testmap as tm
from panelspark.expr import evaluate, measure
from panelspark.factors import alpha158, classic, formulaic, registry, technical  # noqa: F401  importing registers them
from panelspark.operators import cs, ts
from panelspark.portfolio import analysis as an
from panelspark.portfolio import backtest as bt
from panelspark.research import analyst, flows, news, rotation, sentiment, streaks
from panelspark.sources import parse
from panelspark.sources import store as store_ops
from panelspark.sources.tables import work_folder

DIGITS = 6
#: Added before rounding, here and in SQL: prices are cents over small integers, so many values lie right between two digits.
OFF_TIES = 3e-8
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def held(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return held


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(F.col(c) + OFF_TIES, DIGITS).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def r(expr: str, name: str) -> str:
    """A rounded output column of SQL (minus zero becomes zero)."""
    return f"round(({expr}) + {OFF_TIES!r}, {DIGITS}) + 0 AS {name}"


# ---- SQL pieces: rows of an entity in date order -------------------------------------------------------------------------

E = "(PARTITION BY entity ORDER BY dt)"


def w(n: int) -> str:
    return f"(PARTITION BY entity ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(agg: str, x: str, n: int, least: int | None = None) -> str:
    return f"(CASE WHEN count({x}) OVER {w(n)} >= {max(1, n // 2) if least is None else least} THEN {agg}({x}) OVER {w(n)} END)"


def lag(x: str, n: int) -> str:
    return f"lag({x}, {n}) OVER {E}"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


def panel_sql(columns: dict[str, str], bars: str = tm.DAILY_SQL, steps: tuple[str, ...] = ()) -> str:
    """Columns over the bars; each step adds columns that the next ones read."""
    inner = f"({bars})"
    for s in steps:
        inner = f"(SELECT *, {s} FROM {inner})"
    return f"SELECT entity, dt, {', '.join(r(x, n) for n, x in columns.items())} FROM {inner}"


def ewm_sql(x: str, span: int, name: str, least: int | None = None) -> tuple[str, str]:
    """A step and an expression: sums scaled by the row number (the panels here are short enough for that)."""
    q = 1 - 2 / (span + 1)
    so_far = "(PARTITION BY entity ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    step = f"sum({x} * pow({q!r}, -rn)) OVER {so_far} AS {name}_n, sum(CASE WHEN {x} IS NOT NULL THEN pow({q!r}, -rn) END) OVER {so_far} AS {name}_d, count({x}) OVER {so_far} AS {name}_c"
    return step, f"(CASE WHEN {name}_c >= {span if least is None else least} AND {x} IS NOT NULL THEN {name}_n / {name}_d END)"


ROW = f"row_number() OVER {E} AS rn"

# ---- technical factors ---------------------------------------------------------------------------------------------------

PRICE = {f"ret_{n}d": div(lag("close", n), "close") + " - 1" for n in (1, 3, 5, 7, 10, 15, 20, 30, 60, 90, 120, 180, 240)}
PRICE |= {f"amp_{n}d": div(f"{roll('max', 'high', n)} - {roll('min', 'low', n)}", lag("close", n)) for n in (3, 5, 7, 10, 20, 60, 90)}
PRICE |= {f"high_low_spread_{n}d": div(roll("max", "high", n), roll("min", "low", n)) + " - 1" for n in (5, 10, 20)}
PRICE |= {"overnight_ret": div("open", lag("close", 1)) + " - 1", "intraday_ret": div("close", "open") + " - 1"}

VOLUME = {f"{k}_change_{n}d": div(x, lag(x, n)) for k, x in (("vol", "volume"), ("amount", "amount")) for n in (3, 5, 10, 20)}
VOLUME |= {f"vol_mean_{n}d": div(roll("avg", "volume", n), roll("avg", "volume", m)) for n, m in ((5, 20), (10, 60), (20, 60), (60, 120))}
VOLUME |= {f"amount_mean_{n}d": div(roll("avg", "amount", n), roll("avg", "amount", m)) for n, m in ((5, 20), (10, 20), (20, 60))}
VOLUME |= {"vol_std_20d": div(roll("stddev_samp", "volume", 20), roll("avg", "volume", 20)), "vol_max_20d": div("volume", roll("max", "volume", 20))}

MOMENT_STEPS = (f"{roll('avg', 'close', 20)} AS cm, {roll('stddev_samp', 'close', 20)} AS cs, {roll('avg', 'volume', 20)} AS vm, {roll('stddev_samp', 'volume', 20)} AS vs",)
ROLLING = {f"close_mean_{n}d": div(roll("avg", "close", n), "close") + " - 1" for n in (3, 5, 7, 10, 20, 30, 60, 90, 120)}
ROLLING |= {f"close_std_{n}d": div(roll("stddev_samp", "close", n), roll("avg", "close", n)) for n in (5, 10, 20, 30, 60, 90, 120)}
ROLLING |= {f"close_{k}_{n}d": div("close", roll(k, "close", n)) for k in ("max", "min") for n in (5, 10, 20, 60)}
ROLLING |= {f"{x}_{k}_20d": div(roll("avg", f"pow({y} - {m}, {p})", 20), f"pow({s}, {p})") for x, y, m, s, k, p in (("close", "close", "cm", "cs", "skew", 3), ("close", "close", "cm", "cs", "kurt", 4), ("vol", "volume", "vm", "vs", "skew", 3))}
ROLLING |= {f"vol_std_{n}d": div(roll("stddev_samp", "volume", n), roll("avg", "volume", n)) for n in (5, 10)}
ROLLING |= {f"{x}_mean_{n}d": div(roll("avg", x, n), "close") for x in ("high", "low") for n in (5, 10)}

MOMENTUM = {f"mom_{n}d": f"close - {lag('close', n)}" for n in (1, 3, 5, 7, 10, 15, 20, 60, 90, 120)}
MOMENTUM |= {f"ma_dev_{n}d": div(f"close - {roll('avg', 'close', n)}", roll("avg", "close", n)) for n in (5, 10, 20, 60)}
MOMENTUM |= {f"ma_dev_{n}_{m}": div(roll("avg", "close", n), roll("avg", "close", m)) + " - 1" for n, m in ((5, 20), (10, 60))}
MOMENTUM |= {f"chg_{n}d": div("close", lag("close", n)) + " - 1" for n in (5, 10, 20, 30, 60, 90)}

DRAWDOWN = {f"dd_{n}d": div("close", roll("max", "close", n)) + " - 1" for n in (5, 10, 20, 60, 120)}
DRAWDOWN |= {f"atr_{n}": div(roll("avg", "high - low", n), "close") for n in (5, 7, 14)}

_PAIRS = (("corr_close_vol_20", "close", "volume"), ("corr_close_amount_20", "close", "amount"), ("corr_high_low_20", "high", "low"))
CORR_STEPS = (", ".join(f"{roll('avg', x, 20)} AS {x}_m, {roll('stddev_samp', x, 20)} AS {x}_s" for x in ("close", "volume", "amount", "high", "low")),)
CORRELATION = {n: div(roll("sum", f"({a} - {a}_m) * ({b} - {b}_m)", 20), f"20 * {a}_s * {b}_s") for n, a, b in _PAIRS}

_EWM = {span: ewm_sql("close", span, f"e{span}") for span in (12, 26)}
_GAIN = {span: (ewm_sql("gain", span, f"g{span}"), ewm_sql("loss", span, f"l{span}")) for span in (6, 9, 14, 24, 48)}
TECH_STEPS = (f"{ROW}, greatest(close - {lag('close', 1)}, 0) AS gain0, {lag('close', 1)} AS before", "CASE WHEN before IS NOT NULL THEN greatest(close - before, 0) END AS gain, CASE WHEN before IS NOT NULL THEN greatest(before - close, 0) END AS loss", ", ".join([s for s, _ in _EWM.values()] + [s for pair in _GAIN.values() for s, _ in pair]))
TECH = {f"rsi_{span}": f"CASE WHEN {loss} > 0 THEN 100 - 100 / (1 + {gain} / {loss}) WHEN {gain} >= 0 THEN 100 END" for span, ((_, gain), (_, loss)) in _GAIN.items()}
TECH |= {"ema_12": div(_EWM[12][1], "close"), "ema_26": div(_EWM[26][1], "close"), "ema_12_26": div(_EWM[12][1], _EWM[26][1])}

_K = ewm_sql("rsv", 3, "k", 1)
_D = ewm_sql("k", 3, "d", 1)
OSC_STEPS = (f"{ROW}, {roll('min', 'low', 9, 1)} AS lo9, {roll('max', 'high', 9, 1)} AS hi9, {lag('close', 1)} AS before", "(close - lo9) / coalesce(nullif(hi9 - lo9, 0), 1) * 100 AS rsv, ln(high / low) AS hl, ln(open / before) AS night, ln(close / open) AS inside", _K[0], f"{_K[1]} AS k", _D[0])
OSCILLATOR = {
    "kdj_k": "k",
    "kdj_d": _D[1],
    "kdj_j": f"3 * k - 2 * {_D[1]}",
    "obv": "sum(CASE WHEN close > before THEN volume WHEN close < before THEN -volume ELSE 0 END) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "parkinson_vol_20d": f"sqrt({roll('sum', 'hl * hl', 20, 5)} / (4 * 1.3863))",
    "yang_zhang_vol_20d": f"sqrt(pow({roll('stddev_samp', 'night', 20, 5)}, 2) + pow({roll('stddev_samp', 'inside', 20, 5)}, 2) * {0.34 / (1.34 + 21 / 19)!r})",
}


def factors(chosen: list[str], panel=tm.bars_daily) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(registry.compute_factors(panel(spark, sf_dir), chosen))


for _name, _columns, _steps in (
    ("price", PRICE, ()),
    ("volume", VOLUME, ()),
    ("rolling", ROLLING, MOMENT_STEPS),
    ("momentum", MOMENTUM, ()),
    ("leverage", DRAWDOWN, ()),
    ("correlation", CORRELATION, CORR_STEPS),
    ("tech", TECH, TECH_STEPS),
    ("oscillator", OSCILLATOR, OSC_STEPS),
):
    assert set(_columns) == set(registry.names(_name)), _name
    query(f"factors_{_name}", panel_sql(_columns, steps=_steps))(factors(sorted(_columns)))

# ---- the 158 factors -----------------------------------------------------------------------------------------------------

_UP, _DOWN = "CASE WHEN open IS NOT NULL AND close IS NOT NULL THEN greatest(open, close) END", "CASE WHEN open IS NOT NULL AND close IS NOT NULL THEN least(open, close) END"
_SPAN = "(high - low + 1e-12)"
CANDLE = {"KMID": div("close - open", "open"), "KLEN": div("high - low", "open"), "KMID2": f"(close - open) / {_SPAN}", "KUP": div(f"high - ({_UP})", "open"), "KUP2": f"(high - ({_UP})) / {_SPAN}"}
CANDLE |= {"KLOW": div(f"({_DOWN}) - low", "open"), "KLOW2": f"(({_DOWN}) - low) / {_SPAN}", "KSFT": div("2 * close - high - low", "open"), "KSFT2": f"(2 * close - high - low) / {_SPAN}"}
PRICE0 = {f"{x.upper()}0": div(x, "close") for x in ("open", "high", "low", "vwap")}
query("alpha158_kbar", panel_sql(CANDLE))(factors(sorted(CANDLE)))
query("alpha158_price", panel_sql(PRICE0))(factors(sorted(PRICE0)))

RET_STEPS = (
    f"{ROW}, close - {lag('close', 1)} AS d, volume - {lag('volume', 1)} AS dv, {div('close', lag('close', 1))} - 1 AS ret, ln(volume + 1) AS lv, ln(abs({div('volume', lag('volume', 1))} - 1) + 1) AS lvr",
    "CAST(rn AS DOUBLE) AS x, abs(ret) * volume AS flow",
)


def rolling_158(n: int) -> tuple[dict[str, str], tuple[str, ...]]:
    least = max(5, n // 2)
    agg = lambda f, x: roll(f, x, n, least)
    seen = f"count(close) OVER {w(n)} >= {least}"
    pair = lambda f, a, b: f"{f}({a}, {b}) OVER {w(n)}"
    both = lambda a, b: f"count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) OVER {w(n)} >= {least}"
    steps = (
        *RET_STEPS,
        f"{agg('avg', 'close')} AS ma, CASE WHEN {seen} AND count(close) OVER {w(n)} = count(*) OVER {w(n)} THEN {pair('covar_pop', 'close', 'x')} / nullif(var_pop(x) OVER {w(n)}, 0) END AS slope, avg(x) OVER {w(n)} AS xm, var_pop(x) OVER {w(n)} AS xv, var_pop(close) OVER {w(n)} AS cv, {agg('max', 'high')} AS hh, {agg('min', 'low')} AS ll, list(high) OVER {w(n)} AS hs, list(low) OVER {w(n)} AS ls",
        "CASE WHEN hh IS NOT NULL THEN list_position(hs, hh) END - 1 AS top, CASE WHEN ll IS NOT NULL THEN list_position(ls, ll) END - 1 AS bottom",
    )
    up, down = f"{roll('avg', 'CASE WHEN d > 0 THEN 1.0 ELSE 0.0 END', n, least)}", f"{roll('avg', 'CASE WHEN d < 0 THEN 1.0 ELSE 0.0 END', n, least)}"
    cols = {
        "ROC": div(lag("close", 1), lag("close", n + 1)) + " - 1",
        "MA": div("ma", "close"),
        "STD": div(agg("stddev_samp", "close"), "close"),
        "BETA": div("slope", "close"),
        "RSQR": f"CASE WHEN {agg('max', 'close')} > {agg('min', 'close')} THEN slope * slope * xv / cv WHEN slope IS NOT NULL THEN 0 END",
        "RESI": div("close - (ma + slope * (x - xm))", "close"),
        "MAX": div("hh", "close"),
        "MIN": div("ll", "close"),
        "QTLU": div(f"(CASE WHEN {seen} THEN quantile_cont(close, 0.8) OVER {w(n)} END)", "close"),
        "QTLD": div(f"(CASE WHEN {seen} THEN quantile_cont(close, 0.2) OVER {w(n)} END)", "close"),
        "RANK": "CASE WHEN ma IS NOT NULL THEN (rank() OVER (PARTITION BY dt ORDER BY ma NULLS LAST) + (count(*) OVER (PARTITION BY dt, ma) - 1) / 2) / (count(ma) OVER (PARTITION BY dt)) END",
        "RSV": "(close - ll) / (hh - ll + 1e-12)",
        "IMAX": f"top / {n}.0",
        "IMIN": f"bottom / {n}.0",
        "IMXD": f"(top - bottom) / {n}.0",
        "CORR": f"CASE WHEN {both('close', 'lv')} THEN {pair('corr', 'close', 'lv')} END",
        "CORD": f"CASE WHEN {both('ret', 'lvr')} THEN {pair('corr', 'ret', 'lvr')} END",
        "CNTP": up,
        "CNTN": down,
        "CNTD": f"{up} - {down}",
        "VMA": f"{agg('avg', 'volume')} / (volume + 1e-12)",
        "VSTD": f"{agg('stddev_samp', 'volume')} / (volume + 1e-12)",
        "WVMA": f"{agg('stddev_samp', 'flow')} / ({agg('avg', 'flow')} + 1e-12)",
    }
    for p, d in (("", "d"), ("V", "dv")):
        all_ = f"({agg('sum', f'abs({d})')} + 1e-12)"
        cols |= {f"{p}SUMP": f"{agg('sum', f'CASE WHEN {d} IS NOT NULL THEN greatest({d}, 0) END')} / {all_}", f"{p}SUMN": f"{agg('sum', f'CASE WHEN {d} IS NOT NULL THEN abs(least({d}, 0)) END')} / {all_}", f"{p}SUMD": f"{agg('sum', d)} / {all_}"}
    return {f"{k}{n}": v for k, v in cols.items()}, steps


for _n in alpha158.WINDOWS:
    _columns, _steps = rolling_158(_n)
    assert set(_columns) == set(registry.names(f"alpha158_rolling_{_n}")), _n
    query(f"alpha158_rolling_{_n}", panel_sql(_columns, tm.WEEKLY_SQL, _steps))(factors(sorted(_columns), tm.bars_weekly))

# ---- flagship: deviation from the mean and volatility, processed by date, top ten of the last date ---------------------------


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = registry.processed_factors(tm.bars_weekly(spark, sf_dir), ["ma_dev_20d", "vol_1m"])
    last = made.agg(F.max("dt").alias("dt"))
    return rounded(made.join(F.broadcast(last), "dt").orderBy(F.col("ma_dev_20d").desc(), "entity").limit(10).select("entity", "dt", "ma_dev_20d", "vol_1m"))


def process_sql(columns: list[str], inner: str) -> str:
    """Winsorized at the 1 and 99 per cent quantiles and standardized, by date."""
    clip = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, quantile_cont({c}, 0.99) OVER (PARTITION BY dt)), quantile_cont({c}, 0.01) OVER (PARTITION BY dt)) END AS {c}" for c in columns)
    z = ", ".join(f"CASE WHEN coalesce(stddev_samp({c}) OVER (PARTITION BY dt), 0) = 0 THEN 0 ELSE ({c} - avg({c}) OVER (PARTITION BY dt)) / stddev_samp({c}) OVER (PARTITION BY dt) END AS {c}" for c in columns)
    return f"SELECT entity, dt, {z} FROM (SELECT entity, dt, {clip} FROM ({inner}))"


_VOL = roll("stddev_samp", "ret", 21, 10)
_BASE = f"SELECT entity, dt, {MOMENTUM['ma_dev_20d']} AS ma_dev_20d, {_VOL} * sqrt(252) AS vol_1m FROM (SELECT *, {div('close', lag('close', 1))} - 1 AS ret FROM ({tm.WEEKLY_SQL}))"
_PROCESSED = process_sql(["ma_dev_20d", "vol_1m"], _BASE)
query("flagship", f"SELECT entity, dt, {r('ma_dev_20d', 'ma_dev_20d')}, {r('vol_1m', 'vol_1m')} FROM ({_PROCESSED}) q WHERE dt = (SELECT max(dt) FROM ({_PROCESSED})) ORDER BY q.ma_dev_20d DESC, entity LIMIT 10")(flagship)


@query("processed_factors", f"SELECT entity, dt, {r('ma_dev_20d', 'ma_dev_20d')}, {r('vol_1m', 'vol_1m')} FROM ({_PROCESSED})")
def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(registry.processed_factors(tm.bars_weekly(spark, sf_dir), ["ma_dev_20d", "vol_1m"]))


_NEUTRAL = f"""
WITH f AS (SELECT b.entity, b.dt, ma_dev_20d AS y, ln(cap) AS m, industry FROM ({_BASE}) b JOIN ({tm.SUPPLIERS_SQL}) s ON b.entity = s.entity),
     g AS (SELECT *, count(y) OVER (PARTITION BY dt) AS n, min(CASE WHEN y IS NOT NULL THEN industry END) OVER (PARTITION BY dt) AS first FROM f),
     h AS (SELECT *, CASE WHEN industry = first THEN y ELSE y - avg(y) OVER p END AS yy, CASE WHEN y IS NOT NULL THEN CASE WHEN industry = first THEN m ELSE m - avg(CASE WHEN y IS NOT NULL THEN m END) OVER p END END AS mm
           FROM g WINDOW p AS (PARTITION BY dt, industry)),
     k AS (SELECT *, coalesce(sum(yy * mm) OVER (PARTITION BY dt) / nullif(sum(mm * mm) OVER (PARTITION BY dt), 0), 0) AS beta FROM h)
SELECT entity, dt, {r('CASE WHEN y IS NOT NULL AND n >= 30 THEN yy - beta * mm ELSE y END', 'ma_dev_20d')} FROM k
"""


@query("neutralised_factor", _NEUTRAL)
def neutralised(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = registry.compute_factors(tm.bars_weekly(spark, sf_dir), ["ma_dev_20d"]).join(tm.suppliers(spark, sf_dir), "entity")
    return rounded(cs.neutralise(made, "ma_dev_20d", "cap", "industry").select("entity", "dt", "ma_dev_20d"))


# ---- classic factors -----------------------------------------------------------------------------------------------------

_SKIP = lambda n: f"{div(lag('close', 1), lag('close', n + 1))} - 1"
CLASSIC_MOMENTUM = {"ret_1m": _SKIP(21), "ret_3m": _SKIP(63), "ret_6m": _SKIP(126), "ret_12m_1m": f"(1 + {_SKIP(252)}) / nullif(1 + {_SKIP(21)}, 0) - 1", "ret_1m_reverse": f"-({div('close', lag('close', 21))} - 1)", "max_ret_1m": roll("max", "ret", 21, 10)}
_RET = (f"{div('close', lag('close', 1))} - 1 AS ret",)
query("classic_momentum", panel_sql(CLASSIC_MOMENTUM, tm.WEEKLY_SQL, _RET))(factors(sorted(CLASSIC_MOMENTUM), tm.bars_weekly))


def with_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars with the return of the whole market (one row for each week, broadcast by its size)."""
    market = evaluate(tm.bars_market(spark, sf_dir, weekly=True), {"market_ret": ts.pct_change(measure("vwap"), 1)}).drop("entity")
    return tm.bars_weekly(spark, sf_dir).join(market, "dt", "left")


_BEFORE = "(PARTITION BY entity ORDER BY dt ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)"
_K21 = f"(count(ret) OVER {w(21)})"
VOLATILITY = {
    "vol_1m": f"{_VOL} * sqrt(252)",
    "vol_3m": f"{roll('stddev_samp', 'ret', 63, 30)} * sqrt(252)",
    "downside_vol_1m": f"{roll('stddev_samp', 'CASE WHEN ret > 0 THEN 0 ELSE ret END', 21, 10)} * sqrt(252)",
    "skew_1m": f"(CASE WHEN {_K21} >= 10 THEN (sum(ret * ret * ret) OVER {w(21)} / {_K21} - 3 * avg(ret) OVER {w(21)} * sum(ret * ret) OVER {w(21)} / {_K21} + 2 * pow(avg(ret) OVER {w(21)}, 3)) / nullif(pow(var_pop(ret) OVER {w(21)}, 1.5), 0) * sqrt({_K21} * ({_K21} - 1)) / ({_K21} - 2) END)",
    "beta_1y": f"(CASE WHEN count(own) OVER {w(252)} >= 60 THEN covar_samp(own, other) OVER {w(252)} / nullif(var_samp(other) OVER {w(252)}, 0) END)",
    "idiosyncratic_vol": f"(CASE WHEN count(own) OVER {_BEFORE} = 60 AND var_samp(other) OVER {_BEFORE} <> 0 THEN sqrt(greatest(var_samp(own) OVER {_BEFORE} - pow(covar_samp(own, other) OVER {_BEFORE}, 2) / var_samp(other) OVER {_BEFORE}, 0)) * sqrt(252) END)",
}
_MARKET = f"SELECT b.*, m.market_ret FROM ({tm.WEEKLY_SQL}) b LEFT JOIN (SELECT dt, vwap / {lag('vwap', 1)} - 1 AS market_ret FROM ({tm.MARKET_WEEKLY_SQL})) m ON b.dt = m.dt"
query("classic_volatility", panel_sql(VOLATILITY, _MARKET, (*_RET, "CASE WHEN market_ret IS NOT NULL THEN ret END AS own, CASE WHEN ret IS NOT NULL THEN market_ret END AS other")))(factors(sorted(VOLATILITY), with_market))


# ---- portfolios: two factors of the weekly panel, five dates a period ------------------------------------------------------

STORE = ["chg_5d", "ma_dev_20d"]
N_SIDE, FREQ, GROUPS = 10, 5, 5


def store_and_prices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The factor store and the closes of the weekly bars, out of one pass over the lines."""
    made = registry.factor_table(tm.bars_weekly(spark, sf_dir), STORE, work_folder(spark, "store"))
    return registry.long_form(made.drop("close")), made.select("entity", "dt", "close")


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_and_prices(spark, sf_dir)[0]


_STORE = f"SELECT * FROM (SELECT entity, dt, unnest([{{'factor': 'chg_5d', 'value': c}}, {{'factor': 'ma_dev_20d', 'value': m}}], recursive := true) FROM (SELECT entity, dt, {MOMENTUM['chg_5d']} AS c, {MOMENTUM['ma_dev_20d']} AS m FROM ({tm.WEEKLY_SQL}))) WHERE value IS NOT NULL"
_BOOK = f"""
WITH bars AS ({tm.WEEKLY_SQL}), store AS ({_STORE}),
 days AS (SELECT factor, dt, row_number() OVER (PARTITION BY factor ORDER BY dt) - 1 AS k FROM (SELECT DISTINCT factor, dt FROM store)),
 ret AS (SELECT entity, dt, close / lag(close) OVER (PARTITION BY entity ORDER BY dt) - 1 AS ret FROM bars),
 ranked AS (SELECT s.factor, k // {FREQ} AS period, s.dt, entity, value, row_number() OVER (PARTITION BY s.factor, s.dt ORDER BY value DESC, entity) AS hi,
   row_number() OVER (PARTITION BY s.factor, s.dt ORDER BY value, entity) AS lo, count(*) OVER (PARTITION BY s.factor, s.dt) AS n
   FROM store s JOIN days d ON s.factor = d.factor AND s.dt = d.dt WHERE k % {FREQ} = 0),
 both_days AS (SELECT factor, dt, k // {FREQ} AS period FROM days UNION ALL SELECT factor, dt, k // {FREQ} - 1 FROM days WHERE k % {FREQ} = 0 AND k > 0),
 after_days AS (SELECT factor, dt, k // {FREQ} AS period FROM days WHERE k % {FREQ} <> 0 UNION ALL SELECT factor, dt, k // {FREQ} - 1 FROM days WHERE k % {FREQ} = 0 AND k > 0),
 legs AS (SELECT r.factor, d.dt, r.period, avg(ret) FILTER (hi <= {N_SIDE}) AS l, avg(ret) FILTER (lo <= {N_SIDE}) AS s FROM ranked r JOIN both_days d ON r.factor = d.factor AND r.period = d.period
   JOIN ret ON ret.entity = r.entity AND ret.dt = d.dt WHERE hi <= {N_SIDE} OR lo <= {N_SIDE} GROUP BY 1, 2, 3),
 book AS (SELECT factor, dt, sum(l) - {2 * 0.0013 / FREQ!r} AS long_ret, sum(s) - {2 * 0.0013 / FREQ!r} AS short_ret, sum(l) - sum(s) AS ls_ret FROM legs GROUP BY 1, 2)
"""


def book(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bt.long_short_returns(*store_and_prices(spark, sf_dir), N_SIDE, N_SIDE, FREQ)


query("portfolio_long_short", f"{_BOOK} SELECT factor, dt, {r('long_ret', 'long_ret')}, {r('short_ret', 'short_ret')}, {r('ls_ret', 'ls_ret')} FROM book")(lambda spark, sf_dir: rounded(book(spark, sf_dir)))

_NAV = f"{_BOOK}, small AS (SELECT factor, dt, ls_ret / 100 AS ret FROM book), nav AS (SELECT *, product(1 + ret) OVER (PARTITION BY factor ORDER BY dt) AS nav FROM small), dd AS (SELECT *, nav / greatest(max(nav) OVER (PARTITION BY factor ORDER BY dt), 1) - 1 AS dd, nav / max(nav) OVER (PARTITION BY factor ORDER BY dt) - 1 AS dd0 FROM nav)"


def small_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of the test panel are wild; a hundredth of them compounds."""
    return book(spark, sf_dir).select("factor", "dt", (F.col("ls_ret") / 100).alias("ls_ret"))


query("portfolio_nav", f"{_NAV} SELECT factor, dt, {r('ret', 'ls_ret')}, {r('nav', 'ls_nav')} FROM nav")(lambda spark, sf_dir: rounded(bt.with_nav(small_book(spark, sf_dir), ("ls_ret",))))

_ANNUAL = "(pow(arg_max(nav, dt), 252.0 / count(*)) - 1)"
query("portfolio_metrics", f"""{_NAV} SELECT factor, count(*) AS n, {r('arg_max(nav, dt) - 1', 'total_return')}, {r(_ANNUAL, 'annual_return')}, {r('stddev_samp(ret) * sqrt(252)', 'volatility')}, {r(f'{_ANNUAL} / (stddev_samp(ret) * sqrt(252))', 'sharpe')},
 {r('min(dd)', 'max_dd')}, arg_min(dt, (dd, dt)) AS max_dd_date, {r(f'{_ANNUAL} / -min(dd)', 'calmar')}, {r('avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END)', 'win_rate')}, {r('avg(ret) FILTER (ret > 0) / -avg(ret) FILTER (ret < 0)', 'profit_loss')} FROM dd GROUP BY factor""")(lambda spark, sf_dir: rounded(bt.metrics(small_book(spark, sf_dir))))

query("portfolio_tear_sheet", f"""{_NAV}, isl AS (SELECT *, sum(CASE WHEN dd0 >= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY factor ORDER BY dt) AS island, quantile_cont(ret, 0.05) OVER (PARTITION BY factor) AS v FROM dd),
 runs AS (SELECT factor, max(run) AS dd_days FROM (SELECT factor, island, count(*) AS run FROM isl WHERE dd0 < 0 GROUP BY 1, 2) GROUP BY 1)
 SELECT isl.factor, {r(_ANNUAL, 'annual_return')}, {r('stddev_samp(ret) * sqrt(252)', 'annual_vol')}, {r(f'{_ANNUAL} / (stddev_samp(ret) * sqrt(252))', 'sharpe')}, {r(f'{_ANNUAL} / (stddev_samp(ret) FILTER (ret < 0) * sqrt(252))', 'sortino')}, {r('min(dd0)', 'max_dd')},
 coalesce(any_value(dd_days), 0) AS dd_days, {r(f'{_ANNUAL} / -min(dd0)', 'calmar')}, {r('any_value(v)', 'var_95')}, {r('avg(ret) FILTER (ret <= v)', 'cvar_95')}, {r('avg(ret) / stddev_pop(ret) * sqrt(252)', 'ir')},
 {r('(avg(pow(ret, 3)) - 3 * avg(ret) * avg(ret * ret) + 2 * pow(avg(ret), 3)) / pow(var_pop(ret), 1.5)', 'skew')}, {r('kurtosis_pop(ret)', 'kurt')}, {r('avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END)', 'positive_days')}
 FROM isl LEFT JOIN runs ON isl.factor = runs.factor GROUP BY isl.factor""")(lambda spark, sf_dir: rounded(an.tear_sheet(small_book(spark, sf_dir))))

query("portfolio_monthly", f"{_NAV} SELECT factor, strftime(dt, '%Y-%m') AS month, {r('product(1 + ret) - 1', 'ret')} FROM small GROUP BY 1, 2")(lambda spark, sf_dir: rounded(an.monthly_returns(small_book(spark, sf_dir))))

query("portfolio_groups", f"""{_BOOK}, g AS (SELECT factor, period, entity, least((hi - 1) // (n // {GROUPS}), {GROUPS - 1}) + 1 AS g FROM ranked WHERE n // {GROUPS} > 0),
 m AS (SELECT g.factor, d.dt, g, avg(ret) AS ret FROM g JOIN after_days d ON g.factor = d.factor AND g.period = d.period JOIN ret ON ret.entity = g.entity AND ret.dt = d.dt GROUP BY 1, 2, 3)
 SELECT factor, dt, {', '.join(r(f'max(ret) FILTER (g = {k})', f'group_{k}') for k in range(1, GROUPS + 1))}, {r(f'max(ret) FILTER (g = 1) - max(ret) FILTER (g = {GROUPS})', 'spread')} FROM m GROUP BY 1, 2""")(lambda spark, sf_dir: rounded(bt.group_table(bt.group_returns(*store_and_prices(spark, sf_dir), GROUPS, FREQ), GROUPS)))

_IC = f"""{_BOOK}, fwd AS (SELECT entity, dt, lead(close, 5) OVER (PARTITION BY entity ORDER BY dt) / close - 1 AS fwd FROM bars),
 p AS (SELECT factor, s.dt, row_number() OVER (PARTITION BY factor, s.dt ORDER BY value, s.entity) AS x, row_number() OVER (PARTITION BY factor, s.dt ORDER BY fwd, s.entity) AS y FROM store s JOIN fwd ON fwd.entity = s.entity AND fwd.dt = s.dt WHERE fwd IS NOT NULL),
 ic AS (SELECT factor, dt, count(*) AS n, corr(x, y) AS ic FROM p GROUP BY 1, 2 HAVING count(*) >= 30)"""
query("portfolio_rank_ic", f"{_IC} SELECT factor, dt, n, {r('ic', 'ic')} FROM ic")(lambda spark, sf_dir: rounded(an.rank_ic(*store_and_prices(spark, sf_dir))))
query("portfolio_ic_summary", f"{_IC} SELECT factor, count(*) AS dates, {r('avg(ic)', 'ic_mean')}, {r('stddev_samp(ic)', 'ic_std')}, {r('avg(CASE WHEN ic > 0 THEN 1.0 ELSE 0.0 END)', 'positive')}, {r('avg(ic) / stddev_samp(ic)', 'icir')} FROM ic GROUP BY 1")(lambda spark, sf_dir: rounded(an.ic_summary(an.rank_ic(*store_and_prices(spark, sf_dir)))))

query("portfolio_turnover", f"""{_BOOK}, w AS (SELECT factor, period, entity, sum(w) AS w FROM (SELECT factor, period, entity, {1 / N_SIDE} AS w FROM ranked WHERE hi <= {N_SIDE} UNION ALL SELECT factor, period, entity, {-1 / N_SIDE} FROM ranked WHERE lo <= {N_SIDE}) GROUP BY 1, 2, 3),
 ch AS (SELECT factor, period, entity, w FROM w UNION ALL SELECT factor, period + 1, entity, -w FROM w), net AS (SELECT factor, period, entity, sum(w) AS w FROM ch GROUP BY 1, 2, 3)
 SELECT factor, period, {r('sum(abs(w)) / 2', 'turnover')} FROM net WHERE period <= (SELECT max(period) FROM w x WHERE x.factor = net.factor) GROUP BY 1, 2""")(lambda spark, sf_dir: rounded(bt.turnover(bt.long_short_positions(store(spark, sf_dir), N_SIDE, N_SIDE, FREQ))))

query("portfolio_composite", f"WITH store AS ({_STORE}) SELECT 'composite' AS factor, entity, dt, {r('sum(coalesce(z, 0))', 'value')} FROM (SELECT *, (value - avg(value) OVER (PARTITION BY factor, dt)) / nullif(stddev_samp(value) OVER (PARTITION BY factor, dt), 0) AS z FROM store) GROUP BY entity, dt")(lambda spark, sf_dir: rounded(bt.composite(store(spark, sf_dir), STORE)))


# ---- ingestion -------------------------------------------------------------------------------------------------------------


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.table(spark, sf_dir, "events")


@query("ingest_event_records", f"SELECT event_id, user_id, CAST(ts AS DATE) AS dt, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, {r('value', 'value')}, CASE WHEN event_type IN ('purchase', 'error') THEN event_type END AS side FROM events")
def ingest_event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = parse.safe_float(F.get_json_object("props", "$.k"))
    return rounded(events(spark, sf_dir).select("event_id", "user_id", F.to_date("ts").alias("dt"), k.alias("k"), "value", F.when(F.col("event_type").isin("purchase", "error"), F.col("event_type")).alias("side")))


@query("ingest_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, CAST(o_orderdate AS DATE) AS dt, quarter(o_orderdate) AS q, isodow(o_orderdate) AS dow FROM orders")
def ingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return tm.table(spark, sf_dir, "orders").select("o_orderkey", compact.alias("compact"), parse.compact_date(compact).alias("dt")).select("*", F.quarter("dt").cast("long").alias("q"), (F.weekday("dt") + 1).cast("long").alias("dow"))


@query("ingest_melt", f"SELECT entity, dt, name, {r('value', 'value')} FROM (UNPIVOT (SELECT entity, dt, open, high, low, close FROM ({tm.WEEKLY_SQL})) ON open, high, low, close INTO NAME name VALUE value)")
def ingest_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(parse.melt(tm.bars_weekly(spark, sf_dir).select("entity", "dt", "open", "high", "low", "close"), ["entity", "dt"], "name"))


_HALVES = "WITH target AS (SELECT user_id, event_type, min(event_id) AS event_id, min(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), batch AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS a, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS z FROM events WHERE event_id % 2 = 1)"


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = events(spark, sf_dir).select("user_id", "event_type", "event_id", "value")
    target = rows.filter("event_id % 2 = 0").groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"), F.min("value").alias("value"))
    return target, rows.filter("event_id % 2 = 1")


@query("store_insert_if_absent", f"{_HALVES} SELECT user_id, event_type, event_id, {r('value', 'value')} FROM target UNION ALL SELECT user_id, event_type, event_id, {r('value', 'value')} FROM batch b WHERE a = 1 AND NOT EXISTS (SELECT 1 FROM target t WHERE t.user_id = b.user_id AND t.event_type = b.event_type)")
def store_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(store_ops.insert_if_absent(*_halves(spark, sf_dir), ["user_id", "event_type"], [F.col("event_id")]))


@query("store_upsert", f"{_HALVES} SELECT coalesce(t.user_id, b.user_id) AS user_id, coalesce(t.event_type, b.event_type) AS event_type, coalesce(b.event_id, t.event_id) AS event_id, {r('coalesce(b.value, t.value)', 'value')} FROM target t FULL JOIN (SELECT * FROM batch WHERE z = 1) b ON t.user_id = b.user_id AND t.event_type = b.event_type")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(store_ops.upsert(*_halves(spark, sf_dir), ["user_id", "event_type"], [F.col("event_id")]))


@query("store_versions", "WITH t AS (SELECT user_id, event_type, event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) SELECT user_id, event_type, event_id AS valid_from, lead(event_id) OVER w AS valid_to, CAST(row_number() OVER w AS INTEGER) AS version FROM t WHERE b IS NULL OR b <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY event_id)")
def store_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_ops.versions(events(spark, sf_dir), ["user_id"], "event_id", ["event_type"])


@query("store_latest", f"SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id, {r('arg_max(value, event_id)', 'value')} FROM events GROUP BY 1")
def store_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(store_ops.latest_by(events(spark, sf_dir).select("user_id", "event_type", "event_id", "value"), ["user_id"], "event_id"))


@query("curated_adjusted_bars", f"SELECT entity, dt, {', '.join(r(f'{c} * adj / last_value(adj) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)', f'{c}_adj') for c in ('open', 'high', 'low', 'close'))}, {r('volume', 'volume')}, {r('amount', 'amount')}, {r('adj', 'adj_factor')} FROM (SELECT *, 1 + (row_number() OVER (PARTITION BY entity ORDER BY dt) // 50) / 10.0 AS adj FROM ({tm.WEEKLY_SQL}))")
def curated_adjusted_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = tm.bars_weekly(spark, sf_dir)
    adj = bars.select("entity", "dt", (1 + F.floor(F.row_number().over(ts.order()) / 50) / 10.0).alias("adj_factor"))
    return rounded(store_ops.forward_adjusted(bars, adj))


@query("curated_yearly_bars", f"SELECT entity, CAST(date_trunc('year', dt) AS DATE) AS period, {r('arg_min(open, dt)', 'open')}, {r('max(high)', 'high')}, {r('min(low)', 'low')}, {r('arg_max(close, dt)', 'close')}, {r('sum(volume)', 'volume')}, {r('sum(amount)', 'amount')} FROM ({tm.DAILY_SQL}) GROUP BY 1, 2")
def curated_yearly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(store_ops.resample(tm.bars_daily(spark, sf_dir), "year"))


@query("incremental_missing_dates", "SELECT CAST(d AS DATE) AS dt FROM range(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) t(d) WHERE isodow(d) < 6 AND CAST(d AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)")
def incremental_missing_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = tm.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("dt"))
    return store_ops.missing_dates(store_ops.calendar(spark, "1995-01-01", "2001-12-30", "weekday"), present)


@query("store_inventory", "SELECT 'orders' AS \"table\", count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys, strftime(min(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS first, strftime(max(CAST(o_orderdate AS DATE)), '%Y-%m-%d') AS last FROM orders UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_suppkey), strftime(min(CAST(l_shipdate AS DATE)), '%Y-%m-%d'), strftime(max(CAST(l_shipdate AS DATE)), '%Y-%m-%d') FROM lineitem")
def store_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = lambda name, c: tm.table(spark, sf_dir, name).withColumn("_day", F.to_date(c))
    return store_ops.inventory({"orders": (day("orders", "o_orderdate"), "o_custkey", "_day"), "lineitem": (day("lineitem", "l_shipdate"), "l_suppkey", "_day")})


# ---- formulaic alphas: SQL by the operator rules of sqltext, and some of them stated directly ---------------------------------


def compiled_sql(names: list[str], bars: str) -> str:
    steps, columns = sqltext.panel_sql(bars, {n: formulaic.ALPHAS[n] for n in names})
    return f"WITH {steps}\n SELECT entity, dt, {', '.join(r(f'CASE WHEN abs({x}) < 3e38 THEN try_cast({x} AS FLOAT)::DOUBLE END', n) for n, x in columns.items())} FROM panel"


def alphas(names: list[str]) -> Callable[[SparkSession, str], DataFrame]:
    """In single precision: some values are far larger than the digits that are compared."""
    single = lambda df: df.select("entity", "dt", *(F.when(F.abs(n) < 3e38, F.col(n).cast("float").cast("double")).alias(n) for n in names))
    return lambda spark, sf_dir: rounded(single(registry.compute_factors(tm.bars_weekly(spark, sf_dir), names)))


_ALPHA_NAMES = sorted(formulaic.ALPHAS)
for _k in range(0, len(_ALPHA_NAMES), 14):
    _some = _ALPHA_NAMES[_k : _k + 14]
    query(f"formulaic_{_some[0][5:]}_{_some[-1][5:]}", compiled_sql(_some, tm.WEEKLY_SQL))(alphas(_some))

_D1, _BEND = f"(close - {lag('close', 1)})", f"(({lag('close', 20)} - {lag('close', 10)}) / 10 - ({lag('close', 10)} - close) / 10)"


def _rank_whole(x: str) -> str:
    x = f"round({x}, 10)::FLOAT"
    return f"(CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY entity ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY entity, {x}) - 1) / 2) / count({x}) OVER (PARTITION BY entity) END)"


SPOT = {
    "alpha006": f"-coalesce(CASE WHEN count(vol) OVER {w(10)} >= 3 AND max(open) OVER {w(10)} > min(open) OVER {w(10)} AND max(vol) OVER {w(10)} > min(vol) OVER {w(10)} THEN corr(open, vol) OVER {w(10)} END, 0)",
    "alpha009": f"CASE WHEN coalesce({roll('min', 'd1', 5, 1)} > 0, false) OR coalesce({roll('max', 'd1', 5, 1)} < 0, false) THEN d1 ELSE -d1 END",
    "alpha012": f"sign(vol - {lag('vol', 1)}) * -d1",
    "alpha020": f"-{_rank_whole('oh')} * {_rank_whole('oc')} * {_rank_whole('ol')}",
    "alpha023": f"CASE WHEN {roll('avg', 'high', 20, 1)} < high THEN -coalesce(high - {lag('high', 2)}, 0) ELSE 0 END",
    "alpha033": _rank_whole("oc1"),
    "alpha041": "sqrt(high * low) - vwap",
    "alpha042": f"{_rank_whole('wc')} / nullif({_rank_whole('wpc')}, 0)",
    "alpha046": "CASE WHEN bend > 0.25 THEN -1 WHEN bend < 0 THEN 1 ELSE -d1 END",
    "alpha049": "CASE WHEN bend < -0.1 THEN 1 ELSE -d1 END",
    "alpha051": "CASE WHEN bend < -0.05 THEN 1 ELSE -d1 END",
    "alpha101": "(close - open) / (high - low + 0.001)",
}
_SPOT_STEPS = (f"volume * 100 AS vol, {_D1} AS d1, {_BEND} AS bend, open - {lag('high', 1)} AS oh, open - {lag('close', 1)} AS oc, open - {lag('low', 1)} AS ol, -1 + open / close AS oc1, vwap - close AS wc, vwap + close AS wpc",)
query("formulaic_spot", panel_sql(SPOT, tm.WEEKLY_SQL, _SPOT_STEPS))(factors(sorted(SPOT), tm.bars_weekly))

# ---- research ------------------------------------------------------------------------------------------------------------------


def _components(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = tm.bars_market(spark, sf_dir, weekly=True)
    own = evaluate(market, {"momentum": sentiment.price_momentum(), "volatility": sentiment.realised_volatility(), "volume": measure("amount") * 1})
    series = own.unpivot(["dt"], ["momentum", "volatility", "volume"], "name", "value")
    return series.unionByName(sentiment.breadth(tm.bars_weekly(spark, sf_dir)).select("dt", F.lit("breadth").alias("name"), "value"))


_MOMENT = roll("avg", "close", 250, 60)
_PARTS = f"""WITH m AS (SELECT *, close / {lag('close', 1)} - 1 AS ret FROM ({tm.MARKET_WEEKLY_SQL})),
 parts AS (SELECT dt, unnest([{{'name': 'momentum', 'value': a}}, {{'name': 'volatility', 'value': b}}, {{'name': 'volume', 'value': amount}}], recursive := true) FROM (SELECT dt, amount, (close - {_MOMENT}) / {_MOMENT} * 100 AS a, {roll('stddev_samp', 'ret', 30, 10)} * sqrt(252) AS b FROM m)
  UNION ALL SELECT dt, 'breadth', avg(CASE WHEN close > ma THEN 1.0 ELSE 0.0 END) * 100 FROM (SELECT *, {roll('avg', 'close', 20, 5)} AS ma FROM ({tm.WEEKLY_SQL})) GROUP BY dt),
 held AS (SELECT *, list(value) OVER q AS seen, count(value) OVER q AS k FROM parts WINDOW q AS (PARTITION BY name ORDER BY dt ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)),
 raw AS (SELECT name, dt, CASE WHEN k >= 60 AND value IS NOT NULL THEN (len(list_filter(seen, lambda v: v < value)) + (len(list_filter(seen, lambda v: v = value)) + 1) / 2) / k * 100 END AS s FROM held),
 scored AS (SELECT name, dt, CASE WHEN name = 'volatility' THEN 100 - s ELSE s END AS score FROM raw)"""


@query("research_scores", f"{_PARTS} SELECT name, dt, {r('score', 'score')} FROM scored")
def research_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sentiment.scores(_components(spark, sf_dir)))


@query("research_sentiment_index", f"{_PARTS} SELECT dt, n_available, {r('i', 'index')}, CASE WHEN i < 20 THEN 'extreme fear' WHEN i < 40 THEN 'fear' WHEN i < 60 THEN 'neutral' WHEN i < 80 THEN 'greed' ELSE 'extreme greed' END AS label FROM (SELECT dt, count(score) AS n_available, CASE WHEN count(score) >= 4 THEN avg(score) END AS i FROM scored GROUP BY dt)")
def research_sentiment_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sentiment.composite_index(sentiment.scores(_components(spark, sf_dir))))


@query("research_side_ratio", f"SELECT CAST(ts AS DATE) AS dt, {r("count(*) FILTER (event_type = 'purchase') / count(*) * 100", 'value')} FROM events WHERE event_type IN ('purchase', 'error') GROUP BY 1")
def research_side_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sentiment.side_ratio(tm.event_days(spark, sf_dir), "purchase", "error"))


_FLOW = "SELECT user_id AS entity, CAST(ts AS DATE) AS dt, sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END) - sum(CASE WHEN event_type = 'error' THEN value ELSE 0 END) AS value FROM events GROUP BY 1, 2"


@query("research_signed_streak", f"WITH t AS (SELECT *, CASE WHEN value > 0 THEN 1 ELSE -1 END AS way FROM ({_FLOW})), u AS (SELECT *, lag(way) OVER {E} AS b FROM t), v AS (SELECT *, sum(CASE WHEN b = way THEN 0 ELSE 1 END) OVER {E} AS island FROM u) SELECT entity, dt, CAST(row_number() OVER (PARTITION BY entity, island ORDER BY dt) * way AS INTEGER) AS streak FROM v")
def research_signed_streak(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda s: F.sum(F.when(F.col("side") == s, F.col("value")).otherwise(0.0))
    flow = tm.event_days(spark, sf_dir).groupBy("entity", "dt").agg((side("purchase") - side("error")).alias("value"))
    return streaks.signed_streak(flow)


_BOARDS = f"WITH d AS (SELECT DISTINCT user_id AS entity, CAST(ts AS DATE) AS dt FROM events WHERE event_type = 'error'), i AS (SELECT *, CASE WHEN dt - lag(dt) OVER {E} = 1 THEN 0 ELSE 1 END AS s FROM d), j AS (SELECT *, sum(s) OVER {E} AS island FROM i)"


@query("research_boards", f"{_BOARDS} SELECT entity, dt, CAST(row_number() OVER (PARTITION BY entity, island ORDER BY dt) AS INTEGER) AS board_count FROM j")
def research_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaks.boards(tm.event_days(spark, sf_dir).filter("side = 'error'"))


_SECTOR_RET = f"SELECT *, close / {lag('close', 1)} - 1 AS ret, sum(amount) OVER (PARTITION BY dt) AS total FROM ({tm.SECTOR_SQL})"


def _rank_date(x: str) -> str:
    return f"(CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY dt ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY dt, {x}) - 1) / 2) / count({x}) OVER (PARTITION BY dt) END)"


_ROTATION = f"""WITH b AS ({_SECTOR_RET}), c AS (SELECT entity, dt, close, ret, amount / total AS share, {roll('stddev_samp', 'ret', 20, 20)} AS vol, close / {lag('close', 20)} - 1 AS mom FROM b),
 s AS (SELECT entity, dt, ret, {_rank_date('mom')} + 1 - ({_rank_date('share')} + {_rank_date('vol')}) / 2 AS score FROM c)"""


@query("research_rotation_score", f"{_ROTATION} SELECT entity, dt, {r('score', 'score')} FROM s")
def research_rotation_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rotation.rotation_score(tm.bars_sector(spark, sf_dir)))


@query("research_rotation_backtest", f"""{_ROTATION}, days AS (SELECT DISTINCT dt, year(dt) * 100 + month(dt) AS period FROM b), p AS (SELECT period, max(dt) AS last, lead(period) OVER (ORDER BY period) AS nxt FROM days GROUP BY 1),
 k AS (SELECT entity, nxt, row_number() OVER (PARTITION BY s.dt ORDER BY round(score, 9) DESC, entity) AS place, count(*) OVER (PARTITION BY s.dt) AS n FROM s JOIN p ON s.dt = p.last WHERE score IS NOT NULL AND nxt IS NOT NULL),
 h AS (SELECT period, d.dt, avg(ret) AS r FROM k JOIN days d ON d.period = k.nxt JOIN c ON c.entity = k.entity AND c.dt = d.dt WHERE place <= 5 AND n >= 5 GROUP BY 1, 2)
 SELECT CAST(period AS INTEGER) AS period, count(r) AS n, {r('product(1 + coalesce(r, 0)) - 1', 'ret')} FROM h GROUP BY 1""")
def research_rotation_backtest(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = tm.bars_sector(spark, sf_dir)
    score = rotation.rotation_score(bars).withColumn("score", F.round("score", 9))
    return rounded(rotation.rotation_backtest(score, bars)).withColumn("period", F.col("period").cast("int"))


@query("research_sector_correlation", f"WITH b AS (SELECT entity, dt, ret FROM ({_SECTOR_RET}) WHERE ret IS NOT NULL), q AS (SELECT * FROM b WHERE dt > (SELECT max(dt) FROM b) - 365) SELECT x.entity AS a, y.entity AS b, count(*) AS n, {r('corr(x.ret, y.ret)', 'corr')} FROM q x JOIN q y ON x.dt = y.dt AND x.entity <> y.entity GROUP BY 1, 2")
def research_sector_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rotation.sector_correlation(tm.bars_sector(spark, sf_dir)))


# ---- news, reports and flows ---------------------------------------------------------------------------------------------------


def _annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("n_chars")
    kind = F.when(n % 5 == 0, "earnings").when(n % 5 == 1, "merger").otherwise("other")
    return tm.news(spark, sf_dir).select("id", "entity", "dt", ((n % 201 - 100) / 100).alias("sentiment"), kind.alias("event_type"), (n % 7 / 7).alias("impact"))


_DAY = f"SELECT entity, dt, avg(s) AS s, count(*) AS n, CASE WHEN sum(i) <> 0 THEN sum(s * i) / sum(i) END AS wt, max(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS e, max(CASE WHEN k = 1 THEN 1 ELSE 0 END) AS g FROM (SELECT *, (n_chars % 201 - 100) / 100 AS s, n_chars % 7 / 7 AS i, n_chars % 5 AS k FROM ({tm.NEWS_SQL})) GROUP BY 1, 2"


@query("news_factors", f"SELECT entity, dt, {r('s', 'news_sentiment')}, n AS news_count, {r(f'avg(coalesce(wt, 0)) OVER {w(5)}', 'news_sentiment_5d')}, coalesce(e, 0) AS news_earnings_flag, coalesce(g, 0) AS news_merger_flag FROM (SELECT entity, dt FROM ({tm.WEEKLY_SQL})) LEFT JOIN ({_DAY}) USING (entity, dt)")
def news_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(news.news_factors(tm.bars_weekly(spark, sf_dir), _annotations(spark, sf_dir)))


def _word_model(texts: list[str]) -> list[str]:
    """A deterministic stand-in for a model: tone and kind by the letters of the whole text; every other reply in a code fence."""
    out = []
    for t in texts:
        up, down = t.count("th"), t.count("in")
        kind = "earnings" if up > 2 * down else "merger" if up < down else "other"
        reply = '{"sentiment": %.2f, "event_type": "%s", "impact": 0.5, "keywords": ["%s"]}' % ((up - down) * 100 // (up + down + 1) / 100, kind, t[:3].strip().replace('"', "").replace("\\", "").replace("\n", ""))
        out.append(f"```json\n{reply}\n```" if up % 2 else reply)
    return out


_TONE = "(length(text) - length(replace(text, '{0}', ''))) // 2"


@query("news_annotation", f"SELECT id, entity, dt, {r('floor((up - down) * 100 / (up + down + 1)) / 100', 'sentiment')}, CASE WHEN up > 2 * down THEN 'earnings' WHEN up < down THEN 'merger' ELSE 'other' END AS event_type, {r('0.5', 'impact')} FROM (SELECT *, {_TONE.format('th')} AS up, {_TONE.format('in')} AS down FROM ({tm.NEWS_SQL}) WHERE length(text) >= 10)")
def news_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of whole texts."""
    return rounded(news.annotate(tm.news(spark, sf_dir), _word_model, max_chars=None).select("id", "entity", "dt", "sentiment", "event_type", "impact"))


def _filled(c: str, n: int) -> str:
    return f"last_value({c} IGNORE NULLS) OVER (PARTITION BY entity ORDER BY dt ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"


REPORT_COLUMNS = {n: _filled(c, 4) for n, c in (("roe_ttm", "roe"), ("roa_ttm", "roa"), ("gross_margin", "grossprofit_margin"), ("net_margin", "netprofit_margin"), ("revenue_growth_yoy", "or_yoy"), ("earnings_growth_yoy", "profit_dedt"), ("asset_growth_yoy", "or_yoy"))}
REPORT_COLUMNS |= {"debt_to_assets": "-" + _filled("debt_to_assets", 4), "earnings_stability": f"-({roll('stddev_samp', 'filled', 20, 8)} / nullif(abs({roll('avg', 'filled', 20, 8)}), 0))"}
query("classic_reports", panel_sql(REPORT_COLUMNS, tm.REPORTS_SQL, (f"{_filled('roe', 20)} AS filled",)))(factors(sorted(REPORT_COLUMNS), tm.reports))


def valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars with the fields of a valuation table, derived from them."""
    c, v = F.col("close"), F.col("volume")
    extra = {"pe_ttm": c - 1000, "pb": c / v, "ps_ttm": v - 20, "dv_ttm": F.col("low") - 900, "total_mv": F.col("amount") * 10, "turnover_rate": v / 10}
    return tm.bars_weekly(spark, sf_dir).select("*", *(x.alias(n) for n, x in extra.items()))


_VALUED = f"SELECT *, close - 1000 AS pe_ttm, close / volume AS pb, volume - 20 AS ps_ttm, low - 900 AS dv_ttm, amount * 10 AS total_mv, volume / 10 AS turnover_rate FROM ({tm.WEEKLY_SQL})"
VALUE = {"pe_ttm": "CASE WHEN pe_ttm > 0 THEN 1 / pe_ttm END", "ep_ttm": "CASE WHEN pe_ttm > 0 THEN 1 / pe_ttm END", "pb_lf": "CASE WHEN pb > 0 THEN 1 / pb END", "sp_ttm": "CASE WHEN ps_ttm > 0 THEN 1 / ps_ttm END", "div_yield": "CASE WHEN dv_ttm > 0 THEN dv_ttm END"}
_TRADED, _TURN = "(total_mv * turnover_rate / 100)", roll("avg", "turnover_rate", 21, 10)
LIQUIDITY = {"ln_market_cap": "ln(total_mv)", "turnover_1m": _TURN, "turnover_cv": div(roll("stddev_samp", "turnover_rate", 21, 10), _TURN), "amihud_illiq": roll("avg", "thin", 21, 10), "dollar_volume_1m": f"CASE WHEN count(traded) OVER {w(21)} >= 10 THEN ln(greatest({roll('avg', 'traded', 21, 10)}, 1)) END"}
query("classic_value", panel_sql(VALUE, _VALUED))(factors(sorted(VALUE), valued))
query("classic_liquidity", panel_sql(LIQUIDITY, _VALUED, (f"{_TRADED} AS traded, {div('close', lag('close', 1))} - 1 AS ret", "abs(ret) / greatest(traded, 1e-8) AS thin")))(factors(sorted(LIQUIDITY), valued))


def market_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.bars_market(spark, sf_dir).withColumn("value", F.col("vwap"))


STATE = {"market_pe_pct": "CASE WHEN len(seen) >= 252 THEN len(list_filter(seen, lambda v: v >= value)) / len(seen) END", "bdi_momentum": div("value", lag("value", 63)) + " - 1", "margin_balance_ratio": div("value", lag("value", 21)) + " - 1", "series_level": "value", "attention": "ln(greatest(value, 1))", "attention_delta_1w": f"ln(greatest(value, 1)) - {lag('ln(greatest(value, 1))', 5)}"}
query("classic_market_state", panel_sql(STATE, f"SELECT *, vwap AS value FROM ({tm.MARKET_SQL})", (f"list(value) OVER {w(1261)} AS seen",)))(factors(sorted(STATE), market_series))


def _flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    market = tm.bars_market(spark, sf_dir, weekly=True)
    return evaluate(market, {"flow": ts.delta(measure("amount"), 1), "close": measure("vwap") * 1, "volume": measure("volume") * 1})


_FLOWS = f"WITH f AS (SELECT entity, dt, amount - {lag('amount', 1)} AS flow, vwap AS close, volume FROM ({tm.MARKET_WEEKLY_SQL})), s AS (SELECT *, {', '.join(f'lead(close, {k}) OVER {E} / close - 1 AS fwd_{k}' for k in flows.HORIZONS)} FROM f)"
_FLOW_LONG = " UNION ALL ".join(f"SELECT {k} AS horizon, flow, fwd_{k} AS fwd, CASE WHEN count(CASE WHEN flow IS NOT NULL AND fwd_{k} IS NOT NULL THEN 1 END) OVER {w(60)} >= 60 THEN corr(flow, fwd_{k}) OVER {w(60)} END AS c FROM s" for k in flows.HORIZONS)


@query("research_flow_ic", f"{_FLOWS}, l AS ({_FLOW_LONG}) SELECT CAST(horizon AS INTEGER) AS horizon, {r('corr(flow, fwd)', 'corr')}, {r('avg(c)', 'rolling_mean')}, {r('stddev_samp(c)', 'rolling_std')}, {r('avg(CASE WHEN c IS NOT NULL THEN CASE WHEN c > 0 THEN 1.0 ELSE 0.0 END END)', 'positive')}, {r('avg(c) / stddev_samp(c)', 'ir')} FROM l GROUP BY 1")
def research_flow_ic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(flows.flow_ic(flows.study_frame(_flow(spark, sf_dir))))


_Z60 = lambda c: f"(({c} - {roll('avg', c, 60, 60)}) / nullif({roll('stddev_samp', c, 60, 60)}, 0))"


@query("research_resonance", f"{_FLOWS}, z AS (SELECT entity, dt, {_Z60('flow')} AS a, {_Z60('volume')} AS b FROM f) SELECT entity, dt, CASE WHEN a > 1 AND b > 1 THEN 1 WHEN a < -1 AND b < -1 THEN -1 ELSE 0 END AS signal FROM z")
def research_resonance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.resonance(_flow(spark, sf_dir), ["flow", "volume"])


# ---- further operators ---------------------------------------------------------------------------------------------------------

_MACD = (ewm_sql("close", 12, "f"), ewm_sql("close", 26, "s"))
_DEA = ewm_sql("dif", 9, "d")
_MACD_STEPS = (ROW, f"{_MACD[0][0]}, {_MACD[1][0]}", f"{_MACD[0][1]} - {_MACD[1][1]} AS dif", _DEA[0])


@query("ts_macd", panel_sql({"dif": "dif", "dea": _DEA[1], "macd": f"2 * (dif - {_DEA[1]})"}, tm.WEEKLY_SQL, _MACD_STEPS))
def ts_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    dif, dea, hist = ts.macd(measure("close"))
    return rounded(evaluate(tm.bars_weekly(spark, sf_dir), {"dif": dif, "dea": dea, "macd": hist}))


@query("panel_densify", f"WITH b AS ({tm.WEEKLY_SQL}), s AS (SELECT entity, min(dt) AS lo, max(dt) AS hi FROM b GROUP BY 1), d AS (SELECT DISTINCT dt FROM b) SELECT s.entity, d.dt, {r('close', 'close')} FROM s JOIN d ON d.dt BETWEEN lo AND hi LEFT JOIN b ON b.entity = s.entity AND b.dt = d.dt")
def panel_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(cs.densify(tm.bars_weekly(spark, sf_dir).select("entity", "dt", "close")))


_CROSS = {"rank_ordinal": "CASE WHEN m IS NOT NULL THEN row_number() OVER (PARTITION BY dt ORDER BY m NULLS LAST, entity) / count(m) OVER (PARTITION BY dt) END", "scale": "(m - avg(m) OVER (PARTITION BY dt)) / nullif(stddev_samp(m) OVER (PARTITION BY dt), 0)"}


@query("cs_rank_scale", panel_sql(_CROSS, tm.WEEKLY_SQL, (f"{MOMENTUM['chg_5d']} AS m",)))
def cs_rank_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = ts.pct_change(measure("close"), 5)
    return rounded(evaluate(tm.bars_weekly(spark, sf_dir), {"rank_ordinal": cs.rank_ordinal(m), "scale": cs.scale(m)}))


_LAGS = 20
_DECAY = f"""{_BOOK}, a AS (SELECT entity, dt, unnest([{', '.join(f"{{'lag': {k}, 'fwd': lead(close, {k}) OVER {E} / close - 1}}" for k in range(1, _LAGS + 1))}], recursive := true) FROM bars),
 j AS (SELECT factor, lag, s.entity, s.dt, fwd FROM store s JOIN a ON a.entity = s.entity AND a.dt = s.dt WHERE fwd IS NOT NULL),
 v AS (SELECT factor, entity, dt, rank() OVER (PARTITION BY factor ORDER BY value) + (count(*) OVER (PARTITION BY factor, value) - 1) / 2 AS x FROM store),
 z AS (SELECT j.factor, lag, x, rank() OVER (PARTITION BY j.factor, lag ORDER BY fwd) + (count(*) OVER (PARTITION BY j.factor, lag, fwd) - 1) / 2 AS y FROM j JOIN v ON v.factor = j.factor AND v.entity = j.entity AND v.dt = j.dt)
 SELECT factor, CAST(lag AS INTEGER) AS lag, count(*) AS n, {r('corr(x, y)', 'ic')} FROM z GROUP BY 1, 2"""
query("portfolio_ic_decay", _DECAY)(lambda spark, sf_dir: rounded(an.ic_decay(*store_and_prices(spark, sf_dir), _LAGS)))

_CAPITALS = (1e6, 1e7, 1e8)
_CAPACITY = " UNION ALL ".join(f"SELECT factor, {c!r} AS capital, sqrt({c!r} / 1000) * 0.0005 AS i, a, s FROM m" for c in _CAPITALS)
query("portfolio_capacity", f"{_NAV}, m AS (SELECT factor, {_ANNUAL} AS a, {_ANNUAL} / (stddev_samp(ret) * sqrt(252)) AS s FROM dd GROUP BY 1) SELECT factor, {r('capital', 'capital')}, {r('i', 'impact')}, {r('a - i * 100 * 252', 'annual_return')}, {r('(a - i * 100 * 252) / a * s', 'sharpe')} FROM ({_CAPACITY})")(lambda spark, sf_dir: rounded(an.capacity(bt.metrics(small_book(spark, sf_dir)), list(_CAPITALS))))


@query("portfolio_rebalance_costs", f"""{_BOOK}, e AS (SELECT max(period) AS p FROM ranked WHERE factor = 'chg_5d'), t AS (SELECT entity, CASE WHEN hi <= {N_SIDE} THEN {1 / N_SIDE} ELSE {-1 / N_SIDE} END AS wt, period FROM ranked WHERE factor = 'chg_5d' AND (hi <= {N_SIDE} OR lo <= {N_SIDE})),
 x AS (SELECT entity, sum(wt) AS wt FROM t, e WHERE period = p GROUP BY 1), y AS (SELECT entity, sum(wt) AS wt FROM t, e WHERE period = p - 1 GROUP BY 1), v AS (SELECT entity, avg(amount) AS adv, stddev_samp(amount) / avg(amount) / 100 AS sigma FROM bars GROUP BY 1),
 c AS (SELECT coalesce(x.entity, y.entity) AS entity, (coalesce(x.wt, 0) - coalesce(y.wt, 0)) * 1e6 AS change FROM x FULL JOIN y ON x.entity = y.entity)
 SELECT c.entity, {r('change', 'change')}, {r('CASE WHEN adv > 0 THEN sigma * 0.314 * sqrt(abs(change) / adv) + sigma * 0.142 * pow(abs(change) / adv, 0.6) + 0.00025 + greatest(abs(change) * 0.0003, 5) / abs(change) ELSE 0.0006 END * abs(change)', 'cost')} FROM c LEFT JOIN v ON v.entity = c.entity WHERE abs(change) >= 100""")
def portfolio_rebalance_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = bt.long_short_positions(store(spark, sf_dir), N_SIDE, N_SIDE, FREQ).filter("factor = 'chg_5d'")
    end = F.broadcast(held.agg(F.max("period").alias("end")))
    now, before = (held.join(end, F.col("period") == F.col("end") - k).groupBy("entity").agg(F.sum("weight").alias("weight")) for k in (0, 1))
    prices = tm.bars_weekly(spark, sf_dir).groupBy("entity").agg(F.avg("amount").alias("adv"), (F.stddev_samp("amount") / F.avg("amount") / 100).alias("sigma"))
    return rounded(bt.rebalance_costs(now, before, prices, 1e6))


_KINDS = f"{_BOARDS}, k AS (SELECT entity, dt, CASE WHEN row_number() OVER (PARTITION BY entity, island ORDER BY dt) = 1 THEN 'first' ELSE 'consecutive' END AS kind FROM j)"
_PRICES = "SELECT user_id AS entity, CAST(ts AS DATE) AS dt, max(value) AS close FROM events GROUP BY 1, 2"


@query("research_next_day", f"{_KINDS}, p AS ({_PRICES}), n AS (SELECT entity, dt, lead(close) OVER {E} / nullif(close, 0) - 1 AS nx FROM p), m AS (SELECT dt, avg(nx) AS mk FROM n GROUP BY 1) SELECT kind, count(*) AS n, {r('avg(CASE WHEN nx > 0 THEN 1.0 ELSE 0.0 END)', 'win_rate')}, {r('avg(nx)', 'mean')}, {r('median(nx)', 'median')}, {r('avg(nx - mk)', 'excess')} FROM k JOIN n ON n.entity = k.entity AND n.dt = k.dt JOIN m ON m.dt = k.dt WHERE nx IS NOT NULL GROUP BY 1 HAVING count(*) >= 10")
def research_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = tm.event_days(spark, sf_dir)
    board = streaks.boards(days.filter("side = 'error'")).withColumn("kind", F.when(F.col("board_count") == 1, "first").otherwise("consecutive"))
    return rounded(streaks.next_day_study(board, days.groupBy("entity", "dt").agg(F.max("value").alias("close"))))


@query("research_contagion", "SELECT size, count(*) AS days FROM (SELECT CAST(ts AS DATE) AS dt, user_id % 10 AS industry, count(*) AS size FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS ts FROM events WHERE event_type = 'error') GROUP BY 1, 2) GROUP BY 1")
def research_contagion(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = tm.event_days(spark, sf_dir).filter("side = 'error'").select("entity", "dt", (F.col("entity") % 10).alias("industry")).distinct()
    return streaks.contagion(hits)


def _forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as covered stocks: ratings and estimates out of their keys and balances, in three snapshots."""
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    cols = {"stock_code": k, "industry": F.col("c_mktsegment"), "snapshot_date": F.col("c_nationkey") % 3, "rating_buy_num": k % 7, "rating_add_num": k % 5, "rating_org_num": k % 11, "eps1": bal / 1000, "eps2": bal / 900 + 1, "aim_price_max": F.abs(bal) + 10, "aim_price_min": F.abs(bal) / 2 + 5}
    return tm.table(spark, sf_dir, "customer").select(*(c.alias(n) for n, c in cols.items()))


@query("research_analyst_factors", f"SELECT c_mktsegment AS industry, {r('avg((c_custkey % 7 + c_custkey % 5) / greatest(c_custkey % 11, 1))', 'buy_share')}, {r('quantile_cont((c_acctbal / 900 + 1 - c_acctbal / 1000) / greatest(abs(c_acctbal / 1000), 0.01), 0.5)', 'growth')}, {r('quantile_cont((abs(c_acctbal) + 10) / (abs(c_acctbal) / 2 + 5), 0.5)', 'target_spread')}, CAST(sum(c_custkey % 11) AS BIGINT) AS coverage FROM customer WHERE c_nationkey % 3 = (SELECT max(c_nationkey % 3) FROM customer) GROUP BY 1")
def research_analyst_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(analyst.analyst_factors(analyst.latest_snapshot(_forecasts(spark, sf_dir))))


def _z(c: str, over: str) -> str:
    return f"({c} - avg({c}) OVER {over}) / greatest(stddev_samp({c}) OVER {over}, 1e-8)"


_SECTOR = f"WITH b AS ({_SECTOR_RET}), c AS (SELECT entity, dt, -(close / {lag('close', 5)} - 1) AS rev, -{roll('stddev_samp', 'ret', 20, 20)} AS calm FROM b), d AS (SELECT * FROM c WHERE rev IS NOT NULL AND calm IS NOT NULL)"
_DAY_Z = f"0.2 * {_z('rev', '(PARTITION BY dt)')} + 0.15 * {_z('calm', '(PARTITION BY dt)')}"
_BONUS = "CASE WHEN dt = (SELECT max(dt) FROM d) THEN coalesce(bonus, 0) ELSE 0 END"


@query("research_sector_scores", f"{_SECTOR}, x AS (SELECT entity, 0.1 * {_z('size', '()')} AS bonus FROM (SELECT p_brand AS entity, avg(p_size) AS size FROM part GROUP BY 1)) SELECT d.entity, dt, {r(f'{_DAY_Z} + {_BONUS}', 'score')} FROM d LEFT JOIN x ON x.entity = d.entity")
def research_sector_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    close = measure("close")
    own = evaluate(tm.bars_sector(spark, sf_dir), {"rev": -ts.pct_change(close, 5), "calm": -ts.std(ts.pct_change(close, 1), 20, 20)})
    size = tm.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("entity")).agg(F.avg("p_size").alias("size"))
    return rounded(analyst.sector_scores(own, {"rev": 0.2, "calm": 0.15}, size, {"size": 0.1}))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
