"""Readers with their default datasets, on small tables of the stored schema."""

from __future__ import annotations

import datetime as dt

import pytest

from panelspark.sources import readers

TABLES = {
    "raw_stock_daily": ("ts_code string, trade_date timestamp, open double, high double, low double, close double, pre_close double, change double, pct_chg double, vol double, amount double, raw_json string", [("a.SZ", dt.datetime(2024, 1, d), 1.0 * d, 2.0 * d, 0.5 * d, 1.5 * d, 1.0, 0.1, 1.0, v, 30.0, "{}") for d, v in ((2, 10.0), (3, 0.0), (4, None))]),
    "raw_index_daily": ("ts_code string, trade_date string, open double, high double, low double, close double, pre_close double, change double, pct_chg double, vol double, amount double", [(c, f"202401{d:02d}", 1.0, 1.0, 1.0, 1.0 * d, 1.0, 0.0, 0.0, 5.0, 6.0) for c in ("000300.SH", "000905.SH") for d in (2, 3, 4)]),
    "raw_daily_basic": ("ts_code string, trade_date timestamp, close double, turnover_rate double, turnover_rate_f double, volume_ratio double, pe double, pe_ttm double, pb double, ps double, ps_ttm double, dv_ratio double, dv_ttm double, total_mv double, circ_mv double", [("a.SZ", dt.datetime(2024, 1, 2, 15), 1.0, 2.0, 2.1, 1.0, 9.0, 8.0, 1.2, 3.0, 3.1, 0.1, 0.2, 100.0, 80.0)]),
    "raw_financial_indicators": ("ts_code string, ann_date string, end_date timestamp, roe double, roa double, grossprofit_margin double, netprofit_margin double, debt_to_assets double, or_yoy double, profit_dedt double", [("a.SZ", "20240430", dt.datetime(2024, 3, 31), 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0), ("a.SZ", "20240830", dt.datetime(2024, 6, 30), 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)]),
    "raw_macro_indicator": ("source string, date string, sub_key string, value double, change_pct double", [("cpi", "2024-01-02", "city", 1.0, None), ("cpi", "2024-01-03", "", None, None), ("ppi", "2024-01-04", "", 3.0, None), ("pmi", "2024-01-04", "", 4.0, None)]),
    "raw_moneyflow": ("ts_code string, trade_date string, net_mf_vol double, net_mf_amount double", [("a.SZ", "20240102", 1.0, -2.0), ("a.SZ", "20240201", 5.0, 6.0)]),
    "raw_margin_total": ("trade_date string, exchange_id string, rzye double, rzmre double, rzche double, rqye double, rqmcl double, rzrqye double, rqyl double", [("20240102", x, 10.0, 1.0, 2.0, 3.0, 4.0, 13.0, 5.0) for x in ("SSE", "SZSE")]),
    "raw_daily_info": ("trade_date string, ts_code string, ts_name string, float_mv double, total_mv double, amount double, vol double, tr double, exchange string", [("20240102", "SH_A", "", 1.0, 1.0, 7.0, 1.0, 1.0, "SH"), ("20240102", "SZ_A", "", 1.0, 1.0, 8.0, 1.0, 1.0, "SZ"), ("20240102", "HK", "", 1.0, 1.0, 100.0, 1.0, 1.0, "HK")]),
    "raw_moneyflow_hsgt": ("trade_date string, hgt double, sgt double, north_money double, south_money double", [("20240102", 1.0, 2.0, 3.0, 4.0)]),
    "raw_limit_list_d": ("trade_date string, ts_code string, industry string, name string, close double, pct_chg double, amount double, turnover_ratio double, first_time string, last_time string, open_times bigint, lim string", [("20240102", "a.SZ", "x", "A", 1.0, 10.0, 5.0, 2.0, "93749", "145900", 0, "Z"), ("20240102", "b.SZ", "x", "B", 1.0, 9.0, 5.0, 2.0, None, None, 3, "U")]),
    "raw_sw_daily": ("ts_code string, trade_date string, name string, close double, pct_change double, vol double, amount double, pe double, pb double", [("801010.SI", "20240102", "farm", 5.0, 1.0, 3.0, 4.0, 1.0, 1.0)]),
    "raw_index_dailybasic": ("ts_code string, trade_date string, total_mv double, float_mv double, turnover_rate double, pe double, pe_ttm double, pb double", [("000300.SH", "20240102", 1.0, 1.0, 1.0, 11.0, 12.0, 1.3)]),
    "raw_commodity_logistics": ("source string, sub_index string, date string, value double, change_pct double", [("bdi", "BDI", "2024-01-02", 2094.0, None)]),
    "raw_qvix": ("trade_date string, underlying string, open double, high double, low double, close double", [("2024-01-02", "50ETF", 1.0, 1.0, 1.0, 17.5)]),
    "raw_peer_comparison": ("target_symbol string, code string, name string, dimension string, rank_info string, raw_json string", [("a.SZ", "b.SZ", "B", "valuation", "9.0/21", "{}"), ("a.SZ", "c.SZ", "C", "growth", "1.0/21", "{}")]),
}
DAY = dt.date(2024, 1, 2)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("market"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.mark.parametrize("name", sorted(readers.DATASETS))
def test_every_dataset_reads_its_table(spark, base, name):
    data = readers.DATASETS[name]
    rows = readers.read(spark, base, data, "2023-12-31", "2024-12-31")
    assert rows.columns == ["entity", "dt", *data.measures] and dict(rows.dtypes)["dt"] == "date"
    found = rows.collect()
    assert found and all(r["dt"] is not None and r["dt"].year == 2024 for r in found)
    assert readers.read(spark, base, data, "2025-01-01").count() == 0 and readers.read(spark, base, data, None, "2023-12-31").count() == 0


def test_bars_and_closes(spark, base):
    assert [(r["dt"], r["close"]) for r in readers.read_stock_daily(spark, base, "2024-01-02", "2024-01-03").orderBy("dt").collect()] == [(DAY, 3.0), (dt.date(2024, 1, 3), 4.5)]
    bars = readers.read_ohlcv(spark, base).orderBy("dt").collect()
    assert [(r["volume"], r["vwap"]) for r in bars] == [(10.0, 3.0), (0.0, 4.5)]  # no trade: the close; no volume: no bar
    assert readers.load_daily(base, "2024-01-03").count() == 2


def test_index_macro_flows_and_peers(spark, base):
    index = readers.read_index(spark, base, start="2024-01-03").orderBy("dt").collect()
    assert [(r["entity"], r["close"]) for r in index] == [("000300.SH", 3.0), ("000300.SH", 4.0)]
    macro = readers.read_macro(spark, base, ["cpi", "ppi"]).orderBy("dt").collect()
    assert [(r["entity"], r["sub_key"], r["value"]) for r in macro] == [("cpi", "city", 1.0), ("ppi", "", 3.0)]
    assert [tuple(r) for r in readers.read_money_flow(spark, base, "2024-01-01", "2024-01-31").collect()] == [("a.SZ", DAY, 1.0, -2.0)]
    assert [r["roe"] for r in readers.read_reports(spark, base, ["roe"], end="2024-03-31").collect()] == [1.0]
    assert [(r["entity"], r["peer_code"], r["rank_info"]) for r in readers.read_peers(spark, base).collect()] == [("a.SZ", "b.SZ", "9.0/21")]


def test_market_series(spark, base):
    assert [tuple(r) for r in readers.margin_total(spark, base).collect()] == [(DAY, 20.0, 6.0)]
    assert [tuple(r) for r in readers.exchange_amount(spark, base).collect()] == [(DAY, 15.0)]
    assert readers.read(spark, base, readers.DATASETS["northbound"]).collect()[0]["north_money"] == 3.0
    limits = {r["entity"]: r["first_min"] for r in readers.limit_days(spark, base).collect()}
    assert limits == {"a.SZ": pytest.approx(7 + 49 / 60), "b.SZ": None}
    assert readers.sector_bars(spark, base).columns == ["entity", "dt", "name", "close", "pct_change", "vol", "amount"]


def test_text_dates_reach_the_files(spark, base):
    plan = readers.read(spark, base, readers.DATASETS["moneyflow"], "2024-01-02", "2024-01-31")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(trade_date,20240102)" in plan and "LessThan(trade_date,20240201)" in plan


def test_csv_export(spark, base, tmp_path):
    readers.export_csv(readers.read_index(spark, base), str(tmp_path / "index"))
    again = spark.read.option("header", True).csv(str(tmp_path / "index"))
    assert again.count() == 3 and again.columns[:3] == ["entity", "dt", "open"]
