"""Registered queries of readers, ingestion rules and studies over them, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.expr import evaluate
from panelspark.factors import classic
from panelspark.operators import ts
from panelspark.portfolio import backtest as bt
from panelspark.queries import E, events, factors, lag, query, r, roll, rounded, w
from panelspark.research import flows, rotation, sentiment, streaks
from panelspark.sources import parse, readers
from panelspark.sources import store as store_ops
from panelspark.sources.readers import Dataset
from panelspark.streaming import ingest

# ---- readers: the star schema's tables as datasets --------------------------------------------------------------------------

LINES = Dataset("lineitem", "l_suppkey", "l_shipdate", {"open": "l_extendedprice", "high": "l_extendedprice", "low": "l_extendedprice", "close": "l_extendedprice", "volume": "l_quantity", "amount": "l_extendedprice"}, ("l_extendedprice",))
ORDERS = Dataset("orders", "o_custkey", "o_orderdate", {"total": "o_totalprice", "status": "o_orderstatus", "priority": "o_orderpriority"})
CLICKS = Dataset("events", "event_type", "ts", {"value": "value", "user": "user_id"}, ("value",))
_FROM, _TO = "1996-01-01", "1996-12-31"
_IN_1996 = "CAST({} AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"

query("read_stock_daily", f"SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt, {r('l_extendedprice', 'close')} FROM lineitem WHERE {_IN_1996.format('l_shipdate')}")(lambda spark, sf_dir: rounded(readers.read_stock_daily(spark, sf_dir, _FROM, _TO, LINES)))
query("read_ohlcv", f"SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt, {', '.join(r('l_extendedprice', c) for c in ('open', 'high', 'low', 'close'))}, {r('l_quantity', 'volume')}, {r('l_extendedprice', 'amount')}, {r('coalesce(l_extendedprice / nullif(l_quantity, 0), l_extendedprice)', 'vwap')} FROM lineitem WHERE {_IN_1996.format('l_shipdate')}")(lambda spark, sf_dir: rounded(readers.read_ohlcv(spark, sf_dir, _FROM, _TO, data=LINES)))
query("read_index_daily", f"SELECT event_type AS entity, CAST(ts AS DATE) AS dt, {r('value', 'value')}, user_id AS \"user\" FROM events WHERE event_type = 'view' AND CAST(ts AS DATE) >= DATE '2024-01-10'")(lambda spark, sf_dir: rounded(readers.read_index(spark, sf_dir, "view", start="2024-01-10", data=CLICKS)))
query("read_daily_basic", f"SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS dt, {r('o_totalprice', 'total')}, o_orderpriority AS priority FROM orders WHERE {_IN_1996.format('o_orderdate')}")(lambda spark, sf_dir: rounded(readers.read(spark, sf_dir, ORDERS, _FROM, _TO, fields=["total", "priority"])))
query("read_financial_indicators", f"SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS dt, {r('o_totalprice', 'total')} FROM orders")(lambda spark, sf_dir: rounded(readers.read_reports(spark, sf_dir, ["total"], data=ORDERS)))
query("read_macro_indicator", f"SELECT event_type AS entity, CAST(ts AS DATE) AS dt, {r('value', 'value')}, user_id AS \"user\" FROM events WHERE event_type IN ('signup', 'error')")(lambda spark, sf_dir: rounded(readers.read_macro(spark, sf_dir, ["signup", "error"], CLICKS)))
query("read_peer_comparison", f"SELECT c_custkey AS code, c_name AS peer, {r('c_acctbal', 'value')} FROM customer WHERE c_mktsegment = 'BUILDING'")(lambda spark, sf_dir: rounded(readers.read_peers(spark, sf_dir, "BUILDING", "customer", {"code": "c_custkey", "peer": "c_name", "value": "c_acctbal"}, at="c_mktsegment")))
query("read_moneyflow", f"SELECT event_type AS entity, CAST(ts AS DATE) AS dt, {r('value', 'value')} FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")(lambda spark, sf_dir: rounded(readers.read(spark, sf_dir, CLICKS, "2024-01-05", "2024-01-20", fields=["value"])))


_LEAST = "min({'c': l_extendedprice, 'v': l_quantity})"


@query("load_daily", f"SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt, {r(f'{_LEAST}.c', 'close')}, {r(f'{_LEAST}.v', 'volume')} FROM lineitem WHERE l_suppkey IN (1, 2, 3, 5, 8) AND {_IN_1996.format('l_shipdate')} GROUP BY 1, 2")
def load_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = readers.load_daily(sf_dir, _FROM, _TO, [1, 2, 3, 5, 8], LINES).select("entity", "dt", "close", "volume")
    return rounded(readers.to_factor_frame(bars, "entity", "dt"))


@query("load_market_sums", f"SELECT CAST(o_orderdate AS DATE) AS dt, {r('sum(o_totalprice)', 'total')} FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '%HIGH' GROUP BY 1")
def load_market_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_priority = readers.read(spark, sf_dir, Dataset("orders", "o_orderpriority", "o_orderdate", ORDERS.measures))
    return rounded(readers.sum_by_date(readers.codes_like(by_priority, "HIGH"), ["total"], F.col("status").isin("F", "O")))


# ---- views, registries and rules of ingestion -----------------------------------------------------------------------------------


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read(spark, sf_dir, ORDERS)


@query("view_statements", f"SELECT 'orders' AS statement, dt, item, {r('v', 'value')} FROM (SELECT CAST(o_orderdate AS DATE) AS dt, unnest([{{'item': 'total', 'v': max(o_totalprice)}}, {{'item': 'n', 'v': count(*)::DOUBLE}}], recursive := true) FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders) GROUP BY 1 ORDER BY 1 DESC LIMIT 12)")
def view_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_panel(spark, sf_dir)
    first = rows.agg(F.min("entity").alias("e")).first()["e"]
    by_day = rows.groupBy("entity", "dt").agg(F.max("total").alias("total"), F.count("*").alias("n"))
    return rounded(readers.statement_view({"orders": by_day}, first, 6))


_LISTING = "SELECT c_custkey AS code, c_name AS name, CAST(min(o_orderdate) AS DATE) AS listed, CASE WHEN count(*) < 10 THEN CAST(max(o_orderdate) AS DATE) END AS delisted FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2"
_REGISTRY = f"SELECT md5(CAST(code AS VARCHAR)) AS asset_id, code, name, CASE WHEN delisted IS NULL THEN 'active' ELSE 'delisted' END AS status, listed AS valid_from, coalesce(delisted, DATE '{readers.OPEN_END}') AS valid_to FROM ({_LISTING})"


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.count("*") < 10, F.max("dt"))
    days = order_panel(spark, sf_dir).groupBy(F.col("entity").alias("code")).agg(F.min("dt").alias("listed"), last.alias("delisted"))
    names = tm.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.col("c_name").alias("name"))
    return days.join(names, "code").select("code", "name", "listed", "delisted")


query("curated_asset_registry", _REGISTRY)(lambda spark, sf_dir: readers.asset_registry(_listing(spark, sf_dir)))


@query("store_replace_reference", f"WITH a AS ({_REGISTRY}) SELECT * FROM a WHERE code % 2 = 0 UNION ALL SELECT asset_id, code, 'old ' || name, 'active', valid_from, DATE '{readers.OPEN_END}' FROM a WHERE code % 2 = 1 AND code % 3 = 0")
def store_replace_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The even codes are listed anew; of the assets so far (every third code), the odd ones stay as they are."""
    listing = _listing(spark, sf_dir)
    before = listing.filter("code % 3 = 0").select("code", F.concat(F.lit("old "), "name").alias("name"), "listed", F.lit(None).cast("date").alias("delisted"))
    return readers.replace_reference(listing.filter("code % 2 = 0"), readers.asset_registry(before))[1]


@query("curated_yearly_reports", f"WITH t AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS dt, max(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1, 2), y AS (SELECT entity, year(dt) AS year, arg_max(total, dt) AS total FROM t GROUP BY 1, 2), z AS (SELECT entity, year(dt) AS year, arg_max(n, dt) AS n FROM t WHERE n > 0 AND total > 100000 GROUP BY 1, 2) SELECT y.entity, CAST(y.year AS INTEGER) AS year, {r('total', 'total')}, n FROM y LEFT JOIN z ON y.entity = z.entity AND y.year = z.year")
def curated_yearly_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_day = order_panel(spark, sf_dir).groupBy("entity", "dt").agg(F.max("total").alias("total"), F.count("*").alias("n"))
    return rounded(readers.yearly_view(readers.last_per_year(by_day, ["total"]), readers.last_per_year(by_day.filter("total > 100000"), ["n"])))


_MARGIN = "SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS dt, sum(l_extendedprice) AS rzye, sum(l_quantity) AS rqye, sum(l_tax) AS rzmre, sum(l_discount) AS rzche, min(l_quantity) AS rqmcl, min(l_tax) AS rqchl FROM lineitem GROUP BY 1, 2"


@query("curated_margin_changes", f"SELECT entity, dt, {r('rzye - ' + lag('rzye', 1), 'rzye_change')}, {r('rqye - ' + lag('rqye', 1), 'rqye_change')}, {r('(rzmre - rzche) - (rqmcl - rqchl)', 'net_margin_flow')} FROM ({_MARGIN})")
def curated_margin_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tm.table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), F.to_date("l_shipdate").alias("dt"))
    made = lines.agg(F.sum("l_extendedprice").alias("rzye"), F.sum("l_quantity").alias("rqye"), F.sum("l_tax").alias("rzmre"), F.sum("l_discount").alias("rzche"), F.min("l_quantity").alias("rqmcl"), F.min("l_tax").alias("rqchl"))
    return rounded(readers.margin_changes(made))


query("incremental_trading_days", f"SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS dt, {r('o_totalprice', 'total')}, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_suppkey = 1)")(
    lambda spark, sf_dir: rounded(readers.on_trading_days(order_panel(spark, sf_dir), readers.read(spark, sf_dir, LINES, codes=[1])))
)


@query("ingest_routed", f"SELECT event_id, {r('value', 'value')}, CASE WHEN event_type = 'purchase' THEN 'bought' WHEN event_type IN ('error', 'signup') THEN 'other' ELSE 'seen' END AS sink, CAST(ts AS DATE) AS day, DATE '2024-02-01' AS snapshot_date FROM events")
def ingest_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of several shapes: a purchase has an amount, a view or click has a place, the rest neither."""
    rows = events(spark, sf_dir)
    shaped = rows.select("event_id", "value", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"), F.when(F.col("event_type").isin("view", "click"), F.col("props")).alias("place"))
    sinks = readers.routed(shaped, {"bought": ["amount"], "seen": ["place"]}).withColumn("day", readers.day_of(F.col("ts")))
    return rounded(readers.stamped(sinks.drop("ts", "amount", "place"), "2024-02-01"))


query("view_latest_json", """SELECT to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id})::VARCHAR AS json FROM events ORDER BY event_id DESC LIMIT 1""")(lambda spark, sf_dir: readers.latest_json(events(spark, sf_dir), "event_id", ["event_id", "event_type", "user_id"]))


@query("ingest_tagged_union", f"SELECT event_id, CASE WHEN event_type = 'view' THEN props END AS props, CASE WHEN event_type = 'error' THEN {r('value', 'x').removesuffix(' AS x')} END AS value, event_type AS source FROM events WHERE event_type IN ('view', 'error')")
def ingest_tagged_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    feed = lambda kind, c: rows.filter(F.col("event_type") == kind).select("event_id", c)
    return rounded(parse.tagged_union({"view": feed("view", "props"), "error": feed("error", "value")}))


@query("ingest_scalars", f"SELECT event_id, {r('CAST(user_id AS DOUBLE)', 'user_id')}, event_type, {r('value', 'value')}, CAST(ts AS DATE) AS day, CASE WHEN event_type <> 'view' THEN event_type END AS signal FROM events WHERE event_id > 100")
def ingest_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generic coercion, signals, epoch milliseconds and the watermark, over records that are all text."""
    rows = store_ops.above_watermark(events(spark, sf_dir), "event_id", 100)
    text = rows.select(F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("string").alias("user_id"), "event_type", F.col("value").cast("string").alias("value"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("ms"), F.when(F.col("event_type") == "view", "NaN").otherwise(F.col("event_type")).alias("signal"))
    made = parse.coerce_all(text, ["event_id", "event_type", "ms", "signal"])
    return rounded(made.select(parse.safe_int(F.col("event_id")).alias("event_id"), "user_id", "event_type", "value", F.to_date(parse.epoch_millis(F.col("ms"))).alias("day"), parse.keep_if_number(F.col("signal")).alias("signal")))


query("ingest_raw_json", "SELECT event_id, user_id, to_json({'event_id': event_id, 'user_id': user_id})::VARCHAR AS raw_json FROM events")(lambda spark, sf_dir: parse.with_raw(events(spark, sf_dir).select("event_id", "user_id")))

query("stream_windowed_counts", f"SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, {r('sum(value)', 'total')} FROM events GROUP BY 1, 2")(lambda spark, sf_dir: rounded(ingest.windowed_counts(events(spark, sf_dir), "ts", "event_type")))

# ---- factors of named sources, money flow and spreads --------------------------------------------------------------------------


def heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as heat of sources: a value for each user, day and source."""
    source = F.create_map(*(F.lit(x) for pair in (("view", "xq_hot_tweet"), ("click", "xq_hot_deal"), ("signup", "weibo_report")) for x in pair))
    return tm.event_days(spark, sf_dir).groupBy(source[F.col("side")].alias("source"), "entity", "dt").agg(F.sum("value").alias("value")).filter("source is not null")


_HEAT = "SELECT CASE event_type WHEN 'view' THEN 'xq_discussion' WHEN 'click' THEN 'xq_deal_heat' ELSE 'weibo_sentiment' END AS factor, user_id AS entity, CAST(ts AS DATE) AS dt, sum(value) AS value FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1, 2, 3"
query("classic_source_heat", f"SELECT factor, entity, dt, {r('ln(greatest(value, 1))', 'value')} FROM ({_HEAT}) WHERE factor <> 'weibo_sentiment'")(lambda spark, sf_dir: rounded(classic.heat_of_sources(heat(spark, sf_dir))))
query("classic_source_level", f"SELECT factor, entity, dt, {r('value', 'value')} FROM ({_HEAT}) WHERE factor = 'weibo_sentiment'")(lambda spark, sf_dir: rounded(classic.level_of_sources(heat(spark, sf_dir))))

_WEEK_OF = "SELECT dt, vwap AS value FROM ({bars}) WHERE entity = {code}"
query("classic_yield_spread", f"SELECT a.dt, {r('a.value - b.value', 'value')} FROM ({_WEEK_OF.format(bars=tm.WEEKLY_SQL, code=1)}) a JOIN ({_WEEK_OF.format(bars=tm.WEEKLY_SQL, code=2)}) b ON a.dt = b.dt")(
    lambda spark, sf_dir: rounded(classic.yield_spread(*(tm.bars_weekly(spark, sf_dir).filter(F.col("entity") == k).select("dt", F.col("vwap").alias("value")) for k in (1, 2))))
)


def flow_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with a net flow and a free-float value that is missing for every fourth entity."""
    bars = tm.bars_weekly(spark, sf_dir)
    return bars.select("entity", "dt", (F.col("amount") - F.col("open") * F.col("volume")).alias("main_net"), F.when(F.col("entity") % 4 != 0, F.col("amount") * 100).alias("float_mv"))


query("classic_money_flow", f"SELECT entity, dt, {r(roll('sum', 'main_net', 5) + ' / coalesce(float_mv, 1e10)', 'moneyflow_pct_5d')} FROM (SELECT entity, dt, amount - open * volume AS main_net, CASE WHEN entity % 4 <> 0 THEN amount * 100 END AS float_mv FROM ({tm.WEEKLY_SQL}))")(factors(["moneyflow_pct_5d"], flow_panel))

# ---- studies ----------------------------------------------------------------------------------------------------------------

_CUM = "SELECT dt, sum(day) OVER (ORDER BY dt) AS total, sum(bought) AS bought FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS dt, sum(o_totalprice) AS day, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS bought FROM orders GROUP BY 1) GROUP BY dt, day"
_SMART = f"""WITH f AS (SELECT 0 AS entity, c.dt, total, bought, amount, close FROM ({_CUM}) c JOIN ({tm.MARKET_WEEKLY_SQL}) m ON c.dt = m.dt WHERE bought IS NOT NULL),
 g AS (SELECT *, total - {lag('total', 1)} AS flow FROM f),
 h AS (SELECT entity, dt, close, flow, flow / amount * 100 AS flow_pct, bought / amount * 100 AS margin_pct, {', '.join(f"lead(close, {k}) OVER {E} / close - 1 AS fwd_{k}" for k in flows.HORIZONS)} FROM g)"""


def smart_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tm.table(spark, sf_dir, "orders").withColumn("dt", F.to_date(F.date_trunc("week", "o_orderdate")))
    weekly = orders.groupBy("dt").agg(F.sum("o_totalprice").alias("day"), F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("bought"))
    total = weekly.select("dt", F.sum("day").over(Window.partitionBy(F.lit(0)).orderBy("dt")).alias("total"))
    market = tm.bars_market(spark, sf_dir, weekly=True).select("dt", "close", "amount")
    return flows.smart_money_frame(total, market, weekly.select("dt", "bought").filter("bought is not null"))


query("research_smart_money", f"{_SMART} SELECT entity, dt, {', '.join(r(c, c) for c in ('close', 'flow', 'flow_pct', 'margin_pct', *(f'fwd_{k}' for k in flows.HORIZONS)))} FROM h")(lambda spark, sf_dir: rounded(smart_money(spark, sf_dir)))


@query("research_signal_summary", f"{_SMART}, s AS (SELECT *, CASE WHEN flow > {lag('flow', 1)} THEN 1 ELSE 0 END AS signal FROM h) SELECT signal, count(*) AS n, {r('avg(fwd_5)', 'mean_5')}, {r('avg(fwd_20)', 'mean_20')} FROM s GROUP BY 1")
def research_signal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = smart_money(spark, sf_dir)
    return rounded(flows.signal_summary(frame.withColumn("signal", F.when(F.col("flow") > F.lag("flow").over(ts.order()), 1).otherwise(0))))


_STREAK = f"""{_SMART}, t AS (SELECT *, CASE WHEN flow - {roll('avg', 'flow', 20, 1)} > 0 THEN 1 ELSE -1 END AS way FROM h), u AS (SELECT *, sum(CASE WHEN b = way THEN 0 ELSE 1 END) OVER {E} AS island FROM (SELECT *, lag(way) OVER {E} AS b FROM t)),
 v AS (SELECT *, row_number() OVER (PARTITION BY island ORDER BY dt) * way AS streak FROM u), edges AS (SELECT unnest({flows.STREAK_EDGES[:-1]}) AS lo, unnest({flows.STREAK_EDGES[1:]}) AS hi),
 x AS (SELECT streak, unnest([{', '.join(f"{{'horizon': {k}, 'fwd': fwd_{k}}}" for k in flows.HORIZONS)}], recursive := true) FROM v)"""


@query("research_streak_analysis", f"{_STREAK} SELECT CAST(lo AS INTEGER) AS lo, CAST(hi AS INTEGER) AS hi, horizon, count(*) AS n, {r('avg(fwd)', 'mean')}, {r('stddev_samp(fwd)', 'std')}, {r('avg(fwd) * 252 / horizon', 'annual')}, {r('avg(fwd) / nullif(stddev_samp(fwd), 0)', 'ir')} FROM x JOIN edges ON streak >= lo AND streak < hi WHERE fwd IS NOT NULL GROUP BY 1, 2, 3")
def research_streak_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = smart_money(spark, sf_dir)
    over = frame.withColumn("value", F.col("flow") - F.avg("flow").over(ts.rows(20)))
    return rounded(flows.streak_analysis(frame.join(streaks.signed_streak(over), ["entity", "dt"])))


query("research_next_returns", f"WITH n AS (SELECT entity, dt, lead(close) OVER {E} / close - 1 AS nxt FROM ({tm.WEEKLY_SQL})) SELECT entity, dt, {r('nxt', 'next')}, {r('avg(nxt) OVER (PARTITION BY dt)', 'market')} FROM n")(lambda spark, sf_dir: rounded(streaks.next_returns(tm.bars_weekly(spark, sf_dir))))

_BINS = [-0.5, -0.1, -0.02, 0.02, 0.1, 0.5]
query("research_return_bins", f"WITH n AS (SELECT close / {lag('close', 1)} - 1 AS ret, lead(close) OVER {E} / close - 1 AS nxt FROM ({tm.WEEKLY_SQL})), b AS (SELECT unnest({_BINS[:-1]}::DOUBLE[]) AS lo, unnest({_BINS[1:]}::DOUBLE[]) AS hi) SELECT {r('lo', 'lo')}, {r('hi', 'hi')}, count(ret) AS n, {r('avg(nxt)', 'mean')}, {r('stddev_samp(nxt)', 'std')} FROM b LEFT JOIN n ON ret >= lo AND ret < hi GROUP BY b.lo, b.hi")(
    lambda spark, sf_dir: rounded(streaks.binned(tm.bars_weekly(spark, sf_dir).select((F.col("close") / F.lag("close").over(ts.order()) - 1).alias("ret"), (F.lead("close").over(ts.order()) / F.col("close") - 1).alias("next")), "ret", _BINS, "next"))
)

_HITS = "SELECT DISTINCT user_id AS entity, CAST(ts AS DATE) AS dt FROM events WHERE event_type = 'purchase'"
query("research_board_types", f"WITH b AS (SELECT *, row_number() OVER (PARTITION BY entity, island ORDER BY dt) AS k FROM (SELECT entity, dt, dt - CAST(row_number() OVER {E} AS INTEGER) AS island FROM ({_HITS}))) SELECT CASE WHEN k = 1 THEN 'first' ELSE 'consecutive' END AS kind, count(*) AS n, CAST(max(k) AS INTEGER) AS longest FROM b GROUP BY 1")(
    lambda spark, sf_dir: streaks.board_types(streaks.boards(tm.event_days(spark, sf_dir).filter("side = 'purchase'")))
)

_SCORE = f"""WITH b AS (SELECT *, close / {lag('close', 1)} - 1 AS ret, amount / sum(amount) OVER (PARTITION BY dt) AS share FROM ({tm.SECTOR_SQL})),
 c AS (SELECT *, close / {lag('close', 20)} - 1 AS mom, CASE WHEN count(ret) OVER {w(20)} >= 20 THEN stddev_samp(ret) OVER {w(20)} END AS vol FROM b)"""


@query("research_rotation_extremes", f"""{_SCORE}, k AS (SELECT *, {', '.join(f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY dt ORDER BY {x} NULLS LAST) + (count(*) OVER (PARTITION BY dt, {x}) - 1) / 2) / count({x}) OVER (PARTITION BY dt) END AS r_{x}" for x in ('share', 'vol', 'mom'))} FROM c),
 s AS (SELECT entity, dt, r_mom + (1 - (r_share + r_vol) / 2) AS score FROM k), n AS (SELECT entity, score FROM s WHERE score IS NOT NULL AND dt = (SELECT max(dt) FROM s WHERE score IS NOT NULL)), o AS (SELECT *, row_number() OVER (ORDER BY score DESC, entity) AS t, row_number() OVER (ORDER BY score, entity) AS u FROM n)
 SELECT 'top' AS side, CAST(t AS INTEGER) AS place, entity, {r('score', 'score')} FROM o WHERE t <= 5 UNION ALL SELECT 'bottom', CAST(u AS INTEGER), entity, {r('score', 'x').removesuffix(' AS x')} FROM o WHERE u <= 5""")
def research_rotation_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rotation.extremes(rotation.rotation_score(tm.bars_sector(spark, sf_dir))))


query("research_market_amount", f"SELECT dt, {r('sum(amount)', 'value')} FROM ({tm.WEEKLY_SQL}) WHERE entity IN (1, 2) GROUP BY dt")(lambda spark, sf_dir: rounded(sentiment.market_amount(tm.bars_weekly(spark, sf_dir), [1, 2])))
query("research_margin_share", f"SELECT m.dt, {r('bought / amount * 100', 'value')} FROM (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS dt, sum(o_totalprice) AS bought FROM orders GROUP BY 1) b JOIN (SELECT dt, sum(amount) AS amount FROM ({tm.WEEKLY_SQL}) GROUP BY 1) m ON b.dt = m.dt")(
    lambda spark, sf_dir: rounded(sentiment.margin_share(tm.table(spark, sf_dir, "orders").select(F.to_date(F.date_trunc("week", "o_orderdate")).alias("dt"), F.col("o_totalprice").alias("bought")), tm.bars_weekly(spark, sf_dir)))
)

_NORTH = f"WITH a AS (SELECT entity, dt, sum(amount) OVER {E} AS value FROM ({tm.MARKET_WEEKLY_SQL})), b AS (SELECT *, value - {lag('value', 1)} AS d FROM a), c AS (SELECT *, {roll('sum', 'd', 20, 5)} AS s FROM b), z AS (SELECT *, (s - {roll('avg', 's', 252, 20)}) / nullif({roll('stddev_samp', 's', 252, 20)}, 0) AS z FROM c)"
query("research_northbound", f"{_NORTH} SELECT entity, dt, {r('CASE WHEN z IS NOT NULL THEN (least(greatest(z, -3), 3) + 3) / 6 * 100 END', 'northbound')} FROM z")(lambda spark, sf_dir: rounded(northbound(spark, sf_dir)))


def northbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = tm.bars_market(spark, sf_dir, weekly=True).select("entity", "dt", F.sum("amount").over(ts.upto()).alias("value"))
    return evaluate(bars, {"northbound": sentiment.northbound_score()})


query("research_weighted_turnover", f"SELECT dt, {r('sum(volume * cap) / sum(cap)', 'value')} FROM ({tm.WEEKLY_SQL}) b JOIN ({tm.SUPPLIERS_SQL}) s ON b.entity = s.entity WHERE cap > 0 GROUP BY dt")(
    lambda spark, sf_dir: rounded(sentiment.weighted_turnover(tm.bars_weekly(spark, sf_dir).join(tm.suppliers(spark, sf_dir), "entity"), "volume", "cap"))
)


@query("portfolio_custom_strategy", f"WITH b AS (SELECT *, close / {lag('close', 1)} - 1 AS ret FROM ({tm.WEEKLY_SQL})), s AS (SELECT entity, dt, CASE WHEN close > {roll('avg', 'close', 20, 20)} THEN 1.0 ELSE 0.0 END AS wt FROM b), p AS (SELECT entity, dt, lag(wt) OVER {E} AS held FROM s) SELECT b.dt, {r('sum(held * ret) / nullif(sum(abs(held)), 0)', 'ret')} FROM b JOIN p ON b.entity = p.entity AND b.dt = p.dt WHERE held IS NOT NULL AND ret IS NOT NULL GROUP BY b.dt")
def portfolio_custom_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strategy of the user's own: hold what stands above its mean of twenty rows."""
    def above_mean(bars: DataFrame) -> DataFrame:
        full = F.count("close").over(ts.rows(20)) == 20
        return bars.select("entity", "dt", F.when(full & (F.col("close") > F.avg("close").over(ts.rows(20))), 1.0).otherwise(0.0).alias("weight"))

    return rounded(bt.run_strategy(above_mean, tm.bars_weekly(spark, sf_dir)))
