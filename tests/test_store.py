"""Ingestion rules, keyed stores, streaks, backtests and streams on small tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from panelspark.factors import registry, technical  # noqa: F401
from panelspark.operators import cs
from panelspark.portfolio import backtest as bt
from panelspark.research import rotation, streaks
from panelspark.sources import parse, readers, store
from panelspark.streaming import ingest

DAY = dt.date(2024, 1, 1)


def test_dirty_numbers(spark):
    df = spark.createDataFrame([(s,) for s in ("", None, "abc", "NaN", ".00", "1e3", " 7 ")], "s string")
    got = [r[0] for r in df.select(parse.safe_float(F.col("s"))).collect()]
    assert got == [None, None, None, None, 0.0, 1000.0, 7.0]
    assert [r[0] for r in df.select(parse.safe_float(F.col("s"), 1.0)).collect()][:2] == [1.0, 1.0]
    assert [r[0] for r in df.select(parse.safe_int(F.col("s"))).collect()][-2:] == [1000, 7]


def test_dates_and_codes(spark):
    df = spark.createDataFrame([("20240102", "2024-01-02T03:04:05Z", "1.SH", "093100"), ("2024-01-02 09:30:00", "2024-01-02", "2.SZ", "150000"), ("x", "y", "z", None)], "d string, t string, c string, k string")
    got = df.select(parse.compact_date(F.col("d")), parse.iso_timestamp(F.col("t")), parse.exchange_of(F.col("c")), parse.minutes_since_open(F.col("k"))).collect()
    assert [tuple(r) for r in got] == [(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), "SSE", 1), (dt.date(2024, 1, 2), dt.datetime(2024, 1, 2), "SZSE", 330), (None, None, None, None)]


def test_json_shapes(spark):
    text = json.dumps({"category": ["2024-01-02", "2024-01-03"], "data": {"x": ["1.5", "=A1"], "y": ["2", ""]}})
    got = parse.parallel_arrays(spark.createDataFrame([(text,)], "j string"), "j").collect()
    assert sorted(map(tuple, got)) == [("x", "2024-01-02", 1.5), ("y", "2024-01-02", 2.0)]
    lists = spark.createDataFrame([('["0.62","0.38"]',), (json.dumps('["0.62","0.38"]'),), ("nonsense",)], "p string")
    assert [r[0] for r in lists.select(parse.first_number(F.col("p"))).collect()] == [0.62, 0.62, None]
    wide = spark.createDataFrame([("2024-01-02", "2094", None)], "dt string, BDI string, BCI string")
    assert [tuple(r) for r in parse.melt(wide, ["dt"]).collect()] == [("2024-01-02", "BDI", 2094.0)]


def test_validation(spark):
    df = parse.validated(spark.createDataFrame([("a", "1"), ("", "x")], "k string, v string"), ["k"], ["v"])
    assert [r["errors"] for r in df.collect()] == [[], ["k is missing", "v is not a number"]]


def test_first_write_wins_and_upsert(spark):
    target = spark.createDataFrame([("k1", 1.0, "old")], "k string, v double, w string")
    batch = spark.createDataFrame([("k1", 9.0, 1), ("k2", 2.0, 2), ("k2", 3.0, 3)], "k string, v double, seq int")
    got = store.insert_if_absent(target, batch, ["k"], [F.col("seq")]).orderBy("k").collect()
    assert [(r["k"], r["v"]) for r in got] == [("k1", 1.0), ("k2", 2.0)]
    up = store.upsert(target, batch, ["k"], [F.col("seq")]).orderBy("k").collect()
    assert [tuple(r) for r in up] == [("k1", 9.0, "old"), ("k2", 3.0, None)]


def test_missing_dates(spark):
    days = spark.createDataFrame([(DAY + dt.timedelta(days=k),) for k in range(4)], "dt date")
    assert [r["dt"].day for r in store.missing_dates(days, days.filter(F.dayofmonth("dt").isin(1, 3))).orderBy("dt").collect()] == [2, 4]
    ends = [r["dt"] for r in store.calendar(spark, "2024-01-01", "2024-12-31", "quarter").orderBy("dt").collect()]
    assert ends == [dt.date(2024, 3, 31), dt.date(2024, 6, 30), dt.date(2024, 9, 30), dt.date(2024, 12, 31)]


def test_audit_log_keeps_failures(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([(1,)], "a int")
    store.run_job("good", lambda: df, lambda d: d, lambda d: store.export_table(d, str(tmp_path / "out")), log)
    with pytest.raises(ValueError):
        store.run_job("bad", lambda: df, lambda d: d, lambda d: int("x"), log)
    got = {r["pipeline_name"]: (r["status"], r["records_fetched"], r["records_written"]) for r in spark.read.parquet(log).collect()}
    assert got == {"good": ("ok", 1, 1), "bad": ("failed", 1, 0)}


def test_streaks_and_boards(spark):
    flows = [("a", DAY + dt.timedelta(days=k), float(z)) for k, z in enumerate([1, 2, -1, -2, -3, 4, 0, 0])]
    got = streaks.signed_streak(spark.createDataFrame(flows, "entity string, dt date, value double")).orderBy("dt").collect()
    assert [r["streak"] for r in got] == [1, 2, -1, -2, -3, 1, -1, -2]
    hits = spark.createDataFrame([("a", DAY + dt.timedelta(days=k)) for k in (0, 1, 2, 7)], "entity string, dt date")
    assert [r["board_count"] for r in streaks.boards(hits).orderBy("dt").collect()] == [1, 2, 3, 1]


def test_inclusive_boundary_counts_twice(spark):
    days = [DAY + dt.timedelta(days=k) for k in range(3)]
    rets = {"A": [0.01, 0.03, -0.01], "B": [-0.02, 0.0, 0.02]}
    prices, price = [], {"A": 100.0, "B": 100.0}
    for e in rets:
        prices.append((e, DAY - dt.timedelta(days=1), 100.0))
    for k, d in enumerate(days):
        for e in rets:
            price[e] *= 1 + rets[e][k]
            prices.append((e, d, price[e]))
    best = ["A", "B", "B"]
    factor = [("f", e, d, 1.0 if e == best[k] else 0.0) for k, d in enumerate(days) for e in rets]
    store_ = spark.createDataFrame(factor, "factor string, entity string, dt date, value double")
    bars = spark.createDataFrame(prices, "entity string, dt date, close double")
    got = bt.long_short_returns(store_, bars, 1, 1, 1, 0.0, 0.0).orderBy("dt").collect()
    assert [r["long_ret"] for r in got] == [pytest.approx(z) for z in (0.01, 0.03, 0.04)]
    half = bt.long_short_returns(store_, bars, 1, 1, 1, 0.0, 0.0, boundary="half_open").orderBy("dt").collect()
    assert [r["long_ret"] for r in half] == [pytest.approx(z) for z in (0.03, 0.02)]


def test_trade_costs(spark):
    row = spark.createDataFrame([(1e6, 1e8, 0.02), (0.0, 1e8, 0.02)], "v double, adv double, s double")
    got = [r[0] for r in row.select(bt.trade_cost(F.col("v"), F.col("adv"), F.col("s"))).collect()]
    want = 0.02 * 0.314 * 0.1 + 0.02 * 0.142 * 0.01**0.6 + 0.00025 + 300 / 1e6
    assert got == [pytest.approx(want), pytest.approx(0.0006)]


def test_stream_equals_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    rows = [{"id": k % 5, "ts": f"2024-01-01T00:00:{k:02d}", "value": k} for k in range(20)]
    (source / "a.json").write_text("\n".join(map(json.dumps, rows)))
    stream = ingest.record_stream(spark, str(source), "id long, ts timestamp, value double")
    query = ingest.append_to(ingest.deduplicated(stream, ["id"], "ts"), out, str(tmp_path / "ck"))
    query.awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]


def test_export_and_registry(spark, tmp_path):
    bars = [("a", DAY + dt.timedelta(days=k), 10.0, 11.0 + k, 9.0, 10.0 + k, 100.0 + k, 1000.0) for k in range(30)]
    panel = spark.createDataFrame(bars, "entity string, dt date, open double, high double, low double, close double, volume double, amount double")
    registry.export_factors(panel, ["ret_1d", "atr_5"], str(tmp_path / "f"), chunk=1)
    got = spark.read.parquet(str(tmp_path / "f"))
    assert {r["factor"] for r in got.select("factor").distinct().collect()} == {"ret_1d", "atr_5"}
    assert sum(len(registry.names(c)) for c in ("price", "volume", "rolling", "tech", "momentum", "leverage", "correlation")) == 116


def test_batches_of_a_stream_run_the_batch_job(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for k in range(3):
        (source / f"{k}.json").write_text(json.dumps({"id": k, "ts": "2024-01-01T00:00:00", "value": float(k)}))
    stream = ingest.record_stream(spark, str(source), "id long, ts timestamp, value double", files_per_batch=1)
    ingest.run_batches(stream, lambda df, n: store.first_by_key(df, ["id"], [F.col("ts")]).write.mode("append").parquet(out), str(tmp_path / "ck")).awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2]


def test_align_and_period_stats(spark):
    a, b = (spark.createDataFrame([(e, DAY, v) for e, v in rows], f"entity string, dt date, {n} double") for n, rows in (("x", [("p", 1.0), ("q", 2.0)]), ("y", [("q", 3.0), ("r", 4.0)])))
    assert [tuple(r) for r in cs.align(a, b).collect()] == [("q", DAY, 2.0, 3.0)]
    row = rotation.period_stats(spark.createDataFrame([(1, 0.1), (2, -0.5), (3, 0.2)], "period int, ret double")).first()
    assert (row["n"], row["total"], row["win_rate"], row["max_dd"]) == (3, pytest.approx(1.1 * 0.5 * 1.2 - 1), pytest.approx(2 / 3), pytest.approx(-0.5))
    assert row["annual"] == pytest.approx((1.1 * 0.5 * 1.2) ** (52 / 3) - 1)


def test_export_of_an_empty_table_leaves_nothing(spark, tmp_path):
    path = tmp_path / "none"
    assert store.export_table(spark.createDataFrame([], "x int"), str(path)) == 0 and not path.exists()


def test_readers_push_their_filters_to_the_files(spark):
    data = readers.Dataset("orders", "o_custkey", "o_orderdate", {"total": "o_totalprice"}, ("o_totalprice",))
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = readers.read(spark, "/root/testdata/sf0.001", data, "1996-01-01", "1996-06-30", [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and all(x in plan for x in ("GreaterThanOrEqual(o_orderdate", "LessThan(o_orderdate", "In(o_custkey", "IsNotNull(o_totalprice)"))
    assert "o_orderpriority" not in plan


def test_limit_days_and_symbols(spark):
    from datetime import date

    from panelspark.research import streaks

    rows = [("a", date(2024, 1, d), lim, 10.0, m) for d, lim, m in ((1, "Z", 5.0), (2, "Z", 20.0), (3, "U", 7.0), (4, "Z", 300.0), (5, "D", None))]
    limits = spark.createDataFrame(rows, "entity string, dt date, lim string, pct_chg double, first_min double")
    got = {r["dt"].day: (r["kind"], r["board_count"]) for r in streaks.limit_kinds(limits).collect()}
    assert got == {1: ("first", 1), 2: ("consecutive", 2), 3: ("broken", None), 4: ("first", 1), 5: ("other", None)}
    assert streaks.time_effect(limits).count() == 0
    assert [(r["lo"], r["n"]) for r in streaks.time_effect(limits, least=3).orderBy("lo").collect() if r["n"]] == [(0.0, 1), (15.0, 1), (240.0, 1)]
    pairs = spark.createDataFrame([("BTC/USDT",), ("A/B",), (None,)], "p string")
    assert [r[0] for r in pairs.select(parse.symbol_of(F.col("p"))).collect()] == ["BTCUSDT", "AB", None]
    assert [r[0] for r in pairs.select(parse.safe_text(F.col("p"), 3)).collect()] == ["BTC", "A/B", ""]
