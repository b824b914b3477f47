"""Panels from star-schema tables: daily and weekly bars of suppliers, brands and the market, fundamentals and event days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(lines: DataFrame, entity: Column, dt: Column, whole: bool = False) -> DataFrame:
    """``whole``: lines are dealt by entity, so that bars lie as windows over entities need them and are not shuffled again."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = lines.filter("l_quantity > 0").select(entity.alias("entity"), dt.alias("dt"), price.alias("p"), order.alias("o"), "l_quantity", "l_extendedprice")
    if whole:
        # The price follows from what is shuffled.
        lines = lines.filter("l_quantity > 0").select(entity.alias("entity"), dt.alias("dt"), order.alias("o"), "l_quantity", "l_extendedprice").repartition("entity")
        rows = lines.withColumn("p", price)
    out = rows.groupBy("entity", "dt").agg(F.min_by("p", F.struct("o", "p")).alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", F.struct("o", "p")).alias("close"), F.sum("l_quantity").alias("volume"), F.sum("l_extendedprice").alias("amount"))
    return out.withColumn("vwap", F.coalesce(F.try_divide("amount", "volume"), "close"))


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar for each supplier and ship date."""
    return _bars(table(spark, sf_dir, "lineitem"), F.col("l_suppkey"), F.to_date("l_shipdate"), whole=True)


def bars_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bar for each supplier and week: a nearly dense panel."""
    return _bars(table(spark, sf_dir, "lineitem"), F.col("l_suppkey"), F.to_date(F.date_trunc("week", "l_shipdate")), whole=True)


def bars_market(spark: SparkSession, sf_dir: str, weekly: bool = False) -> DataFrame:
    """One series for the whole table."""
    dt = F.to_date(F.date_trunc("week", "l_shipdate") if weekly else F.col("l_shipdate"))
    return _bars(table(spark, sf_dir, "lineitem"), F.lit(0).cast("long"), dt)


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, industry (the nation's name) and cap (positive)."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    own = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return own.select(F.col("s_suppkey").alias("entity"), F.col("n_name").alias("industry"), (F.abs("s_acctbal") + 1).alias("cap"))


#: The same bars in SQL; {dt} is the date expression and {entity} the entity.
BARS_SQL = """
SELECT {entity} AS entity, {dt} AS dt, arg_min(p, (o, p)) AS open, max(p) AS high, min(p) AS low, arg_max(p, (o, p)) AS close,
       sum(l_quantity) AS volume, sum(l_extendedprice) AS amount, sum(l_extendedprice) / sum(l_quantity) AS vwap
FROM (SELECT *, l_extendedprice / l_quantity AS p, l_orderkey * 10 + l_linenumber AS o FROM lineitem WHERE l_quantity > 0)
GROUP BY 1, 2
"""
DAILY_SQL = BARS_SQL.format(entity="l_suppkey", dt="CAST(l_shipdate AS DATE)")
WEEKLY_SQL = BARS_SQL.format(entity="l_suppkey", dt="CAST(date_trunc('week', l_shipdate) AS DATE)")
MARKET_SQL = BARS_SQL.format(entity="CAST(0 AS BIGINT)", dt="CAST(l_shipdate AS DATE)")
MARKET_WEEKLY_SQL = BARS_SQL.format(entity="CAST(0 AS BIGINT)", dt="CAST(date_trunc('week', l_shipdate) AS DATE)")
SUPPLIERS_SQL = "SELECT s_suppkey AS entity, n_name AS industry, abs(s_acctbal) + 1 AS cap FROM supplier JOIN nation ON s_nationkey = n_nationkey"


def bars_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weekly bar for each brand of parts."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return _bars(lines, F.col("p_brand"), F.to_date(F.date_trunc("week", "l_shipdate")))


SECTOR_SQL = BARS_SQL.format(entity="p_brand", dt="CAST(date_trunc('week', l_shipdate) AS DATE)").replace("FROM lineitem", "FROM lineitem JOIN part ON l_partkey = p_partkey")


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, dt, side, value): events of users by day."""
    rows = table(spark, sf_dir, "events")
    return rows.select(F.col("user_id").alias("entity"), F.to_date("ts").alias("dt"), F.col("event_type").alias("side"), "value")


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news of suppliers: id, entity, dt (a week of the bars' range), text and n_chars."""
    docs = table(spark, sf_dir, "documents")
    week = F.date_add(F.lit("1995-01-02").cast("date"), ((F.col("doc_id") * 7) % 2499).cast("int"))
    return docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 100).alias("entity"), F.to_date(F.date_trunc("week", week)).alias("dt"), "text", "n_chars")


NEWS_SQL = "SELECT doc_id AS id, doc_id % 100 AS entity, CAST(date_trunc('week', DATE '1995-01-02' + CAST((doc_id * 7) % 2499 AS INTEGER)) AS DATE) AS dt, text, n_chars FROM documents"


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly figures of customers out of their orders, under the names of report fields; quarters without orders are missing."""
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("dt"))
    mean = rows.agg(F.avg("o_totalprice").alias("m"), F.count("*").alias("n"))
    figures = {"roe": F.col("m") / 1000, "roa": F.col("m") / 2000, "grossprofit_margin": F.col("n") * 1.0, "netprofit_margin": F.when(F.col("n") > 1, F.col("m") / 3000), "debt_to_assets": F.col("n") / (F.col("n") + 1), "or_yoy": F.when(F.col("n") > 2, F.col("m") / 4000), "profit_dedt": F.col("m")}
    return mean.select("entity", "dt", *(c.alias(k) for k, c in figures.items()))


REPORTS_SQL = "SELECT entity, dt, m / 1000 AS roe, m / 2000 AS roa, n * 1.0 AS grossprofit_margin, CASE WHEN n > 1 THEN m / 3000 END AS netprofit_margin, n / (n + 1) AS debt_to_assets, CASE WHEN n > 2 THEN m / 4000 END AS or_yoy, m AS profit_dedt FROM (SELECT o_custkey AS entity, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS dt, avg(o_totalprice) AS m, count(*) AS n FROM orders GROUP BY 1, 2)"
