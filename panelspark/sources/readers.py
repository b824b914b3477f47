"""Readers of stored tables: a dataset says which columns of a Parquet table are the entity, the date and the measures.

Range, code and field choices are filters and projections of the scan, so that they reach the files. What comes out is a long
panel: entity, dt and the chosen measures.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources.parse import compact_date, minutes_since_open


@dataclass(frozen=True)
class Dataset:
    """``measures``: name to source column; rows must have all of ``required`` (source columns)."""

    table: str
    entity: str
    date: str
    measures: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    #: Pattern of dates that are text (yyyyMMdd or yyyy-MM-dd); empty where the column is a date or a timestamp.
    text_dates: str = ""


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


_COMPACT, _ISO = "yyyyMMdd", "yyyy-MM-dd"
_OHLC = _same("open", "high", "low", "close")
#: Tables of the market store and their columns.
DATASETS = {
    "stock_daily": Dataset("raw_stock_daily", "ts_code", "trade_date", _OHLC | {"volume": "vol", "amount": "amount"}, ("close",)),
    "index_daily": Dataset("raw_index_daily", "ts_code", "trade_date", _OHLC | _same("pre_close", "change", "pct_chg", "vol", "amount"), text_dates=_COMPACT),
    "daily_basic": Dataset("raw_daily_basic", "ts_code", "trade_date", _same("pe_ttm", "pb", "total_mv", "turnover_rate", "pe", "ps", "ps_ttm", "dv_ratio", "dv_ttm", "circ_mv", "turnover_rate_f", "volume_ratio")),
    "fina_indicator": Dataset("raw_financial_indicators", "ts_code", "end_date", _same("roe", "roa", "grossprofit_margin", "netprofit_margin", "debt_to_assets", "or_yoy", "profit_dedt")),
    "macro_indicator": Dataset("raw_macro_indicator", "source", "date", _same("sub_key", "value"), ("value",), _ISO),
    "moneyflow": Dataset("raw_moneyflow", "ts_code", "trade_date", _same("net_mf_vol", "net_mf_amount"), text_dates=_COMPACT),
    "margin": Dataset("raw_margin_total", "exchange_id", "trade_date", _same("rzye", "rzmre", "rzche", "rqye", "rqmcl", "rzrqye", "rqyl"), text_dates=_COMPACT),
    "northbound": Dataset("raw_moneyflow_hsgt", "", "trade_date", _same("north_money", "south_money", "hgt", "sgt"), text_dates=_COMPACT),
    "exchange_daily": Dataset("raw_daily_info", "exchange", "trade_date", _same("ts_code", "amount", "vol", "float_mv", "total_mv", "tr"), text_dates=_COMPACT),
    "limit_list": Dataset("raw_limit_list_d", "ts_code", "trade_date", _same("industry", "name", "close", "pct_chg", "amount", "turnover_ratio", "first_time", "last_time", "open_times", "lim"), text_dates=_COMPACT),
    "sector_daily": Dataset("raw_sw_daily", "ts_code", "trade_date", _same("name", "close", "pct_change", "vol", "amount", "pe", "pb"), text_dates=_COMPACT),
    "index_basic": Dataset("raw_index_dailybasic", "ts_code", "trade_date", _same("pe", "pe_ttm", "pb", "total_mv", "float_mv", "turnover_rate"), text_dates=_COMPACT),
    "commodity": Dataset("raw_commodity_logistics", "source", "date", _same("sub_index", "value"), ("value",), _ISO),
    "volatility_index": Dataset("raw_qvix", "underlying", "trade_date", _OHLC, ("close",), _ISO),
}
PEERS = {"entity": "target_symbol", "peer_code": "code", "dimension": "dimension", "rank_info": "rank_info", "raw_json": "raw_json"}


def read(spark: SparkSession, base: str, data: Dataset, start: str | None = None, end: str | None = None, codes: Sequence | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """entity, dt and the fields (all measures by default) of the rows in the range, both ends (ISO dates) included."""
    rows = spark.read.parquet(f"{base}/{data.table}.parquet")
    day = F.col(data.date)
    # Bounds are values of the column's own type, so that they reach the files; the day itself ends before the next one starts.
    bound = lambda d: F.lit(d.strftime("%Y%m%d" if data.text_dates == _COMPACT else "%Y-%m-%d")) if data.text_dates else F.lit(d)
    if start:
        rows = rows.filter(day >= bound(date.fromisoformat(start)))
    if end:
        rows = rows.filter(day < bound(date.fromisoformat(end) + timedelta(days=1)))
    if codes is not None:
        rows = rows.filter(F.col(data.entity).isin(list(codes)))
    for c in data.required:
        rows = rows.filter(F.col(c).isNotNull())
    dt = compact_date(day) if data.text_dates else F.to_date(day)
    entity = F.col(data.entity) if data.entity else F.lit("market")
    chosen = data.measures if fields is None else {f: data.measures[f] for f in fields}
    return rows.select(entity.alias("entity"), dt.alias("dt"), *(F.col(c).alias(n) for n, c in chosen.items()))


def read_ohlcv(spark: SparkSession, base: str, start: str | None = None, end: str | None = None, codes: Sequence | None = None, data: Dataset = DATASETS["stock_daily"]) -> DataFrame:
    """Bars that have all of open, high, low, close and volume, and vwap (the close where nothing was traded)."""
    data = replace(data, required=tuple(data.measures[c] for c in ("open", "high", "low", "close", "volume")))
    bars = read(spark, base, data, start, end, codes)
    return bars.withColumn("vwap", F.coalesce(F.try_divide("amount", "volume"), "close"))


def read_stock_daily(spark: SparkSession, base: str, start: str | None = None, end: str | None = None, data: Dataset = DATASETS["stock_daily"]) -> DataFrame:
    """Closes of the range."""
    return read(spark, base, data, start, end, fields=["close"])


def read_index(spark: SparkSession, base: str, code="000300.SH", start: str | None = None, end: str | None = None, data: Dataset = DATASETS["index_daily"]) -> DataFrame:
    return read(spark, base, data, start, end, [code])


def read_reports(spark: SparkSession, base: str, fields: Sequence[str] | None = None, start: str | None = None, end: str | None = None, data: Dataset = DATASETS["fina_indicator"]) -> DataFrame:
    """Quarterly figures, dated by the end of the period."""
    return read(spark, base, data, start, end, fields=fields)


def read_macro(spark: SparkSession, base: str, sources: Sequence, data: Dataset = DATASETS["macro_indicator"]) -> DataFrame:
    return read(spark, base, data, codes=sources)


def read_money_flow(spark: SparkSession, base: str, start: str | None = None, end: str | None = None, data: Dataset = DATASETS["moneyflow"]) -> DataFrame:
    """Net volume and amount of a day."""
    return read(spark, base, data, start, end)


def read_peers(spark: SparkSession, base: str, dimension: str = "valuation", table: str = "raw_peer_comparison", names: dict[str, str] | None = None, at: str = "dimension") -> DataFrame:
    """Rows of one dimension of a comparison, under the names given."""
    rows = spark.read.parquet(f"{base}/{table}.parquet").filter(F.col(at) == dimension)
    return rows.select(*(F.col(c).alias(n) for n, c in (names or PEERS).items()))


def load_daily(base: str, start: str | None = None, end: str | None = None, codes: Sequence | None = None, data: Dataset = DATASETS["stock_daily"]) -> DataFrame:
    """The bars of the range, ready for factors."""
    return read(SparkSession.active(), base, data, start, end, codes)


def to_factor_frame(df: DataFrame, entity: str, date: str) -> DataFrame:
    """Any frame as a panel: entity and dt first, rows without either left out, one row for each pair."""
    rest = [c for c in df.columns if c not in (entity, date)]
    rows = df.filter(F.col(entity).isNotNull() & F.col(date).isNotNull()).select(F.col(entity).alias("entity"), F.to_date(date).alias("dt"), *rest)
    return rows.groupBy("entity", "dt").agg(F.min(F.struct(*rest)).alias("r")).select("entity", "dt", *(F.col(f"r.{c}").alias(c) for c in rest))


def sum_by_date(panel: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """(dt, sums): a market series out of a panel, e.g. margin balances or the amounts of two exchanges."""
    rows = panel if where is None else panel.filter(where)
    return rows.groupBy("dt").agg(*(F.sum(c).alias(c) for c in columns))


def margin_total(spark: SparkSession, base: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(dt, rzye, rqye): both balances over all exchanges."""
    return sum_by_date(read(spark, base, DATASETS["margin"], start, end, fields=["rzye", "rqye"]), ["rzye", "rqye"])


def exchange_amount(spark: SparkSession, base: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(dt, amount): what both main exchanges traded."""
    return sum_by_date(read(spark, base, DATASETS["exchange_daily"], start, end, ["SH", "SZ"], ["amount"]), ["amount"])


def limit_days(spark: SparkSession, base: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The limit list with ``first_min``, the minutes after the open when the limit was first reached."""
    rows = read(spark, base, DATASETS["limit_list"], start, end)
    return rows.withColumn("first_min", minutes_since_open(F.col("first_time")))


def sector_bars(spark: SparkSession, base: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Sectors by day: name, close, change, volume and amount."""
    return read(spark, base, DATASETS["sector_daily"], start, end, fields=["name", "close", "pct_change", "vol", "amount"])


def codes_like(panel: DataFrame, suffix: str) -> DataFrame:
    """The rows of entities whose code ends so (a freight index among macro series, say)."""
    return panel.filter(F.col("entity").cast("string").endswith(suffix))


# ---- views and registries -------------------------------------------------------------------------------------------------


def statement_view(tables: dict[str, DataFrame], entity, n: int = 8) -> DataFrame:
    """(statement, dt, item, value): the items of one entity's last ``n`` reports in each table (entity, dt, items), newest first."""
    out = None
    for name, df in tables.items():
        items = [c for c in df.columns if c not in ("entity", "dt")]
        last = df.filter(F.col("entity") == entity).orderBy(F.col("dt").desc()).limit(n)
        long = last.select(*(F.col(c).cast("double").alias(c) if c in items else c for c in ("dt", *items))).unpivot(["dt"], items, "item", "value").select(F.lit(name).alias("statement"), "*")
        out = long if out is None else out.unionByName(long)
    return out.orderBy("statement", F.col("dt").desc(), "item")


OPEN_END = "2099-12-31"


def asset_registry(listing: DataFrame) -> DataFrame:
    """One row for each code of (code, name, listed, delisted): status, validity and an id that only depends on the code."""
    last = listing.groupBy("code").agg(F.max_by(F.struct("name", "listed", "delisted"), F.coalesce("listed", F.lit("0001-01-01").cast("date"))).alias("r"))
    gone = F.col("r.delisted").isNotNull()
    return last.select(F.md5(F.col("code").cast("string")).alias("asset_id"), "code", "r.name", F.when(gone, "delisted").otherwise("active").alias("status"), F.col("r.listed").alias("valid_from"), F.coalesce("r.delisted", F.lit(OPEN_END).cast("date")).alias("valid_to"))


def replace_reference(batch: DataFrame, assets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reference table's new content (the batch), and the assets with the batch's codes brought up to date or added."""
    from panelspark.sources.store import upsert

    return batch, upsert(assets, asset_registry(batch), ["asset_id"], [F.col("code")])


def last_per_year(reports: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(entity, year, columns): each entity's last report of a year."""
    best = reports.groupBy("entity", F.year("dt").alias("year")).agg(F.max_by(F.struct(*columns), "dt").alias("r"))
    return best.select("entity", "year", *(F.col(f"r.{c}").alias(c) for c in columns))


def yearly_view(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two yearly tables side by side; years that the right one lacks stay."""
    return left.join(right, ["entity", "year"], "left")


def margin_changes(margin: DataFrame) -> DataFrame:
    """Day-over-day changes of both balances and the net flow: financing bought less repaid, less lending sold less returned."""
    from pyspark.sql import Window

    w = Window.partitionBy("entity").orderBy("dt")
    change = lambda c: (F.col(c) - F.lag(c).over(w)).alias(f"{c}_change")
    net = (F.col("rzmre") - F.col("rzche")) - (F.col("rqmcl") - F.col("rqchl"))
    return margin.select("entity", "dt", change("rzye"), change("rqye"), net.alias("net_margin_flow"))


def on_trading_days(df: DataFrame, index: DataFrame, column: str = "dt") -> DataFrame:
    """The rows whose date an index has; the dates of an index are few."""
    days = index.select(F.col("dt").alias(column)).distinct()
    return df.join(days, column, "left_semi")


def routed(df: DataFrame, shapes: dict[str, Sequence[str]], other: str = "other") -> DataFrame:
    """``df`` with a column ``sink``: the first shape whose fields a record has; ``df.filter(sink = ..)`` feeds each table."""
    sink = F.lit(None).cast("string")
    for name, fields in reversed(list(shapes.items())):
        there = F.lit(True)
        for f in fields:
            there = there & F.col(f).isNotNull()
        sink = F.when(there, name).otherwise(sink)
    return df.withColumn("sink", F.coalesce(sink, F.lit(other)))


def stamped(df: DataFrame, run_date: str, column: str = "snapshot_date") -> DataFrame:
    """With the date of the run, which is an argument, so that a rerun writes the same rows."""
    return df.withColumn(column, F.lit(run_date).cast("date"))


def day_of(c: Column) -> Column:
    """The day of a timestamp: key of daily snapshots."""
    return F.date_trunc("day", c).cast("date")


def latest_json(df: DataFrame, at: str, fields: Sequence[str]) -> DataFrame:
    """One row: the latest row's fields as JSON text."""
    best = df.agg(F.max_by(F.struct(*fields), at).alias("r"))
    return best.select(F.to_json("r").alias("json"))


def export_csv(df: DataFrame, path: str) -> None:
    """With a header; Spark's parts lie in one folder."""
    df.write.mode("overwrite").option("header", True).csv(path)
