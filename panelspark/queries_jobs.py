"""Registered queries of incremental jobs, streams and landing files, each with the SQL of what must be in the table at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark import testmap as tm
from panelspark.queries import events, query, r, rounded
from panelspark.research import streaks
from panelspark.sources import parse, store, tables
from panelspark.streaming import ingest

# ---- upsert of touched partitions ------------------------------------------------------------------------------------------------


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tm.table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus", "o_totalprice")


@query("store_upsert_partitions", f"""
WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_totalprice FROM orders),
 b AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY n DESC) AS nth FROM (
   SELECT o_orderkey, year, 'X' AS o_orderstatus, o_totalprice + n AS o_totalprice, n FROM t, (VALUES (1), (2)) v(n) WHERE o_orderkey % 7 = 0 AND year IN (1995, 1996)
   UNION ALL SELECT -o_orderkey, year, o_orderstatus, o_totalprice, 1 FROM t WHERE o_orderkey % 11 = 0 AND year = 1996))
SELECT coalesce(b.o_orderkey, t.o_orderkey) AS o_orderkey, coalesce(b.year, t.year) AS year, coalesce(b.o_orderstatus, t.o_orderstatus) AS o_orderstatus, {r('coalesce(b.o_totalprice, t.o_totalprice)', 'o_totalprice')}
FROM t FULL JOIN (SELECT * FROM b WHERE nth = 1) b ON b.o_orderkey = t.o_orderkey AND b.year = t.year""")
def store_upsert_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of changed orders in one batch, and new ones, into a table by year."""
    orders, path = _priced(spark, sf_dir), tables.work_folder(spark, "upsert")
    keys = ["o_orderkey", "year"]
    tables.upsert_partitions(spark, path, orders.withColumn("n", F.lit(0)), keys, [F.col("n")], ["year"])
    changed = orders.filter("o_orderkey % 7 = 0 and year in (1995, 1996)").withColumn("n", F.explode(F.array(F.lit(1), F.lit(2))))
    changed = changed.withColumn("o_totalprice", F.col("o_totalprice") + F.col("n")).withColumn("o_orderstatus", F.lit("X"))
    new = orders.filter("o_orderkey % 11 = 0 and year = 1996").withColumn("o_orderkey", -F.col("o_orderkey")).withColumn("n", F.lit(1))
    tables.upsert_partitions(spark, path, changed.unionByName(new), keys, [F.col("n")], ["year"])
    return rounded(spark.read.parquet(path).select("o_orderkey", "year", "o_orderstatus", "o_totalprice"))


# ---- versions in batches -----------------------------------------------------------------------------------------------------------

_OBSERVED = "SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1, 2"


@query("store_versions_in_batches", f"""
WITH o AS ({_OBSERVED}), t AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS turn FROM o WINDOW w AS (PARTITION BY user_id ORDER BY day)),
 s AS (SELECT *, sum(turn) OVER (PARTITION BY user_id ORDER BY day) AS version FROM t),
 g AS (SELECT user_id, version, min(event_type) AS event_type, min(day) AS valid_from, max(day) AS seen_to FROM s GROUP BY 1, 2)
SELECT user_id, event_type, valid_from, lead(valid_from) OVER (PARTITION BY user_id ORDER BY version) AS valid_to, CAST(version AS INTEGER) AS version, seen_to FROM g""")
def store_versions_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of users by day in three batches; the last one holds what comes late."""
    seen = events(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("day")).agg(F.max_by("event_type", "event_id").alias("event_type"))
    middle = F.lit("2024-01-16").cast("date")
    part = F.when(F.xxhash64("user_id", "day") % 5 == 0, 2).otherwise(F.when(F.col("day") < middle, 0).otherwise(1))
    batches = [seen.filter(part == k) for k in range(3)]
    args = (["user_id"], "day", ["event_type"])
    now = tables.build_versions(batches[0], *args)
    known = batches[0]
    for batch in batches[1:]:
        path = tables.work_folder(spark, "versions")
        tables.merge_versions(now, batch, known, *args).write.parquet(path)
        now = spark.read.parquet(path)
        known = known.unionByName(batch)
    return now


# ---- a job that resumes -----------------------------------------------------------------------------------------------------------


@query("job_resumed", f"SELECT CAST(ts AS DATE) AS day, count(*) AS n, {r('sum(value)', 'total')}, (SELECT count(*) FROM events) AS rows_total, CAST((SELECT max(event_id) FROM events) AS VARCHAR) AS mark, CAST(3 AS BIGINT) AS runs FROM events GROUP BY 1")
def job_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in three parts; the run of the second one stops between its write and its commit and is repeated."""
    folder = tables.work_folder(spark, "job")
    source = events(spark, sf_dir).select("event_id", F.to_date("ts").alias("day"), "value")
    state = tables.JobState(spark, folder, "events")
    end = source.agg(F.max("event_id")).scalar()

    class Stopped(Exception):
        pass

    def stop() -> None:
        raise Stopped

    for share in (1, 2, 3):
        arrived = source.filter(F.col("event_id") * 3 <= end * share)
        args = (spark, state, arrived, "event_id", f"{folder}/table", ["event_id", "day"], ["day"])
        if share == 2:
            try:
                tables.resume_job(*args, before_commit=stop)
            except Stopped:
                pass
        after = tables.resume_job(*args)
    days = spark.read.parquet(f"{folder}/table").groupBy("day").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rounded(days.select("day", "n", "total", F.lit(after["rows_total"]).cast("long").alias("rows_total"), F.lit(after["mark"]).alias("mark"), F.lit(after["runs"]).cast("long").alias("runs")))


# ---- a stream with state, late rows and a restart -------------------------------------------------------------------------------


@query("stream_event_days", f"SELECT date_trunc('day', ts)::DATE AS day, event_type, count(*) AS n, {r('sum(value)', 'total')} FROM events GROUP BY 1, 2")
def stream_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of five days each; a tenth of the rows comes up to a day late, in the next file, and a seventh comes twice. The
    stream is stopped after half of the files and started again on its checkpoint; a closing row ends the last windows."""
    folder = tables.work_folder(spark, "stream")
    rows = events(spark, sf_dir).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    late = F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    placed = rows.withColumn("part", F.floor((day + late) / 5).cast("int"))
    twice = placed.filter("event_id % 7 = 0").withColumn("part", F.col("part") + 1)
    arrivals = placed.unionByName(twice)
    span = arrivals.agg(F.min("part").alias("lo"), F.max("part").alias("hi")).first()
    if span["lo"] is None:
        return rounded(rows.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")))
    closing = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("2100-01-01").cast("timestamp").alias("ts"), F.lit("end").alias("event_type"), F.lit(None).cast("double").alias("value"))

    def deliver(lo: int, hi: int) -> None:
        for k in range(lo, hi):
            arrivals.filter(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/landing")

    def run() -> None:
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landing")
        counts = ingest.windowed_counts(ingest.deduplicated(stream, ["event_id"], "ts", "2 days"), None, "event_type")
        ingest.append_to(counts, f"{folder}/table", f"{folder}/checkpoint").awaitTermination()

    half = (span["lo"] + span["hi"] + 1) // 2
    deliver(span["lo"], half)
    run()
    deliver(half, span["hi"] + 1)
    closing.coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    run()
    found = spark.read.parquet(f"{folder}/table").filter("event_type <> 'end'")
    return rounded(found.select(F.to_date("start").alias("day"), "event_type", "n", "total"))


# ---- one pass to many sinks, and landing files ------------------------------------------------------------------------------------


@query("ingest_route_once", "SELECT sink, valid, count(*) AS n, count(*) AS counted FROM (SELECT CASE WHEN event_type = 'purchase' THEN 'bought' WHEN event_type = 'view' THEN 'seen' ELSE 'other' END AS sink, NOT (event_type = 'purchase' AND event_id % 9 = 0 OR event_type = 'view' AND user_id % 5 = 0) AS valid FROM events) GROUP BY 1, 2")
def ingest_route_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and views to their own folders; some amounts cannot be read and some views have no place."""
    path = tables.work_folder(spark, "routed")
    rows = events(spark, sf_dir)
    is_ = lambda kind: F.col("event_type") == kind
    amount = F.when(is_("purchase"), F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("value").cast("string")))
    shaped = rows.select("event_id", amount.alias("amount"), F.when(is_("view"), F.col("props")).alias("page"), F.when(is_("view") & (F.col("user_id") % 5 != 0), F.col("user_id").cast("string")).alias("place"))
    found = tables.route_once(shaped, {"bought": ["amount"], "seen": ["page"]}, {"seen": ["place"]}, {"bought": ["amount"]}, path)
    written = spark.read.parquet(path).groupBy("sink", F.col("valid").cast("boolean").alias("valid")).agg(F.count("*").alias("n"))
    counted = F.lit(0)
    for sink, n in found.items():
        for valid, name in ((True, "valid"), (False, "quarantine")):
            counted = F.when((F.col("sink") == sink) & (F.col("valid") == valid), n[name]).otherwise(counted)
    return written.select("sink", "valid", "n", counted.cast("long").alias("counted"))


_LANDED = "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS event_type, value, event_id % 50 = 0 AS damaged FROM events"


@query("ingest_landing", f"SELECT event_type, count(*) AS n, count(CASE WHEN damaged THEN 1 END) AS n_damaged, {r('sum(CASE WHEN NOT damaged THEN value END)', 'total')} FROM (SELECT CASE WHEN NOT damaged THEN event_type END AS event_type, value, damaged FROM ({_LANDED})) GROUP BY 1")
def ingest_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of two shapes (one lacks a column, one has another one), of which every fiftieth is cut off."""
    folder = tables.work_folder(spark, "landing")
    rows = events(spark, sf_dir)
    even = F.to_json(F.struct("event_id", "event_type", "value"))
    odd = F.to_json(F.struct("event_id", "value", F.lit("x").alias("extra")))
    line = F.when(F.col("event_id") % 2 == 0, even).otherwise(odd)
    rows.select(F.when(F.col("event_id") % 50 == 0, F.expr("substring(to_json(struct(event_id, event_type, value)), 1, 15)")).otherwise(line).alias("value")).write.text(folder)
    target = rows.select("event_id", "event_type", "value").limit(0)
    landed = tables.read_landing(spark, folder, target)
    damaged = F.col("_damaged").isNotNull()
    out = landed.groupBy(F.when(~damaged, F.col("event_type")).alias("event_type")).agg(F.count("*").alias("n"), F.count("_damaged").alias("n_damaged"), F.sum(F.when(~damaged, F.col("value"))).alias("total"))
    return rounded(out)


# ---- curated coin bars and the study of limit days ---------------------------------------------------------------------------------

_PAIRS = "CASE WHEN user_id % 3 = 0 THEN 'BTC/USDT' WHEN user_id % 3 = 1 THEN 'X/Y' ELSE 'ETH/USDT' END"
_COINS = f"""SELECT replace({_PAIRS}, '/', '') AS symbol, 'ex' || (user_id % 2) AS exchange, date_trunc('hour', ts) AS timestamp, '1h' AS timeframe,
 arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low, arg_max(value, event_id) AS close, sum(value) AS volume FROM events GROUP BY 1, 2, 3"""


@query("curated_coin_bars", f"""
WITH c AS (SELECT *, row_number() OVER (PARTITION BY timestamp ORDER BY exchange, close) AS nth FROM ({_COINS}) WHERE symbol = 'BTCUSDT'),
 old AS (SELECT * FROM c WHERE nth = 1 AND timestamp < TIMESTAMP '2024-01-10'),
 new AS (SELECT * FROM c WHERE nth = 1 AND timestamp NOT IN (SELECT timestamp FROM old))
SELECT CAST(timestamp AS VARCHAR) AS at, timeframe, {r('-open', 'open')}, {r('close', 'close')}, {r('volume', 'volume')} FROM old
UNION ALL SELECT CAST(timestamp AS VARCHAR), timeframe, {r('open', 'open')}, {r('close', 'close')}, {r('volume', 'volume')} FROM new""")
def curated_coin_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of pairs on two exchanges; bars that were curated before (with another open) stay."""
    pair = F.when(F.col("user_id") % 3 == 0, "BTC/USDT").when(F.col("user_id") % 3 == 1, "X/Y").otherwise("ETH/USDT")
    ticks = events(spark, sf_dir).select(parse.symbol_of(pair).alias("symbol"), F.concat(F.lit("ex"), F.col("user_id") % 2).alias("exchange"), F.date_trunc("hour", "ts").alias("timestamp"), "value", "event_id")
    raw = ticks.groupBy("symbol", "exchange", "timestamp", F.lit("1h").alias("timeframe")).agg(F.min_by("value", "event_id").alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", "event_id").alias("close"), F.sum("value").alias("volume"))
    before = store.curated_bars(raw.filter("timestamp < '2024-01-10'"), "BTCUSDT", "1h").withColumn("open", -F.col("open"))
    out = store.curated_bars(raw, "BTCUSDT", "1h", before)
    return rounded(out.select(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("at"), "timeframe", "open", "close", "volume"))


def limit_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of users as days of limits: what held, what broke, and the time of day as HHMMSS."""
    lim = F.when(F.col("event_type") == "purchase", "Z").when(F.col("event_type") == "error", "U").otherwise("D")
    rows = events(spark, sf_dir).groupBy(F.col("user_id").alias("entity"), F.to_date("ts").alias("dt")).agg(F.max_by(F.struct(lim.alias("lim"), F.col("value").alias("pct_chg"), F.date_format("ts", "HHmmss").alias("first_time")), "event_id").alias("r"))
    return rows.select("entity", "dt", "r.*").withColumn("first_min", parse.minutes_since_open(F.col("first_time")))


_LIMITS = """SELECT user_id AS entity, CAST(ts AS DATE) AS dt, arg_max(CASE event_type WHEN 'purchase' THEN 'Z' WHEN 'error' THEN 'U' ELSE 'D' END, event_id) AS lim, arg_max(value, event_id) AS pct_chg, arg_max(ts, event_id) AS seen FROM events GROUP BY 1, 2"""
_LIMIT_KINDS = f"""WITH l AS ({_LIMITS}), b AS (SELECT entity, dt, row_number() OVER (PARTITION BY entity, island ORDER BY dt) AS k FROM (SELECT entity, dt, dt - CAST(row_number() OVER (PARTITION BY entity ORDER BY dt) AS INTEGER) AS island FROM l WHERE lim = 'Z')),
 kinds AS (SELECT l.*, k AS board_count, CASE WHEN lim = 'Z' THEN CASE WHEN k > 1 THEN 'consecutive' ELSE 'first' END WHEN lim = 'U' THEN 'broken' ELSE 'other' END AS kind FROM l LEFT JOIN b ON l.entity = b.entity AND l.dt = b.dt AND lim = 'Z')"""
_FIRST_MIN = "date_part('hour', seen) * 60 + date_part('minute', seen) + floor(date_part('second', seen)) / 60 - 570"
query("research_limit_kinds", f"{_LIMIT_KINDS} SELECT entity, dt, lim, CAST(board_count AS INTEGER) AS board_count, kind, {r(_FIRST_MIN, 'first_min')} FROM kinds")(
    lambda spark, sf_dir: rounded(streaks.limit_kinds(limit_panel(spark, sf_dir)).select("entity", "dt", "lim", "board_count", "kind", "first_min"))
)

_INDEX = "SELECT CAST(ts AS DATE) AS dt, avg(value) AS close FROM events GROUP BY 1"
_NEXT = "SELECT entity, dt, lead(pct_chg) OVER (PARTITION BY entity ORDER BY dt) / nullif(pct_chg, 0) - 1 AS nx FROM l"


@query("research_limit_next_day", f"""{_LIMIT_KINDS}, n AS ({_NEXT}), m AS (SELECT dt, lead(close) OVER (ORDER BY dt) / nullif(close, 0) - 1 AS mk FROM ({_INDEX}))
SELECT kind, count(*) AS n, {r('avg(CASE WHEN nx > 0 THEN 1.0 ELSE 0.0 END)', 'win_rate')}, {r('avg(nx)', 'mean')}, {r('median(nx)', 'median')}, {r('avg(nx - mk)', 'excess')}
FROM kinds k JOIN n ON n.entity = k.entity AND n.dt = k.dt LEFT JOIN m ON m.dt = k.dt WHERE nx IS NOT NULL GROUP BY 1 HAVING count(*) >= 10""")
def research_limit_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day after a limit day by its kind, against an index."""
    limits = limit_panel(spark, sf_dir)
    index = events(spark, sf_dir).groupBy(F.to_date("ts").alias("dt")).agg(F.avg("value").alias("close"))
    prices = limits.select("entity", "dt", F.col("pct_chg").alias("close"))
    return rounded(streaks.next_day_study(streaks.limit_kinds(limits), prices, market=streaks.index_next(index)))
