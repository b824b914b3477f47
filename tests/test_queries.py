"""Registered queries against their SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
CHOSEN = ["flagship", "processed_factors", "factors_price", "factors_correlation", "factors_oscillator", "alpha158_kbar", "alpha158_rolling_5", "classic_momentum", "portfolio_long_short", "portfolio_groups", "store_upsert", "store_versions", "research_signed_streak", "research_sector_correlation", "read_ohlcv", "load_daily", "store_replace_reference", "curated_yearly_reports", "ingest_scalars", "research_streak_analysis", "portfolio_custom_strategy", "formulaic_029_042", "slots_classic", "store_upsert_partitions", "store_versions_in_batches", "job_resumed", "stream_event_days", "ingest_route_once", "ingest_landing", "curated_coin_bars", "research_limit_kinds", "research_limit_next_day"]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def _rows(columns: list[str], rows: list) -> list:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    plain = lambda x: None if x is None or x != x else round(float(x), 5) if isinstance(x, float) else str(x)
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    want = sql.sql(entry.oracle_sql()[name])
    got, expected = _rows(df.columns, [tuple(r) for r in df.collect()]), _rows(want.columns, want.fetchall())
    assert sorted(df.columns) == sorted(want.columns) and len(got) == len(expected)
    for a, b in zip(got, expected, strict=True):
        for x, y in zip(a, b, strict=True):
            assert x == y or (isinstance(x, float) and isinstance(y, float) and math.isclose(x, y, abs_tol=2e-5))


def test_entry(spark):
    assert 0 < entry.entry(spark).count() <= 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
