"""Shared helpers: key filters, hot keys and worker tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.llm import _common as common


def test_key_filter_has_no_false_negatives(spark):
    keys = spark.range(0, 5000, 7).withColumnRenamed("id", "k")
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    got = common.maybe_among(rows, "k", common.key_filter(keys, "k", keys.count()))
    assert got.count() == 20_000 and got.columns == ["k", "_maybe"]
    passed = {r["k"] for r in got.filter("_maybe").collect()}
    assert set(range(0, 5000, 7)) <= passed and len(passed) < 3000


def test_key_filter_of_nothing(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    assert common.only_maybe(rows, "k", common.key_filter(rows.filter("k < 0"), "k", 0)).count() == 0


def test_hot_keys_meet_all_their_rows(spark):
    rows = spark.range(5000).select((F.when(F.col("id") < 3000, 1).otherwise(F.col("id"))).alias("k"), "id")
    counts = rows.groupBy("k").agg(F.count("*").alias("n")).filter("n > 1 or k % 2 = 0")
    got = common.having_key(rows, "k", counts, 5000)
    assert got.count() == rows.join(counts, "k", "left_semi").count() == 4000


def test_worker_tables_are_bounded():
    made = [common.process_cache(f"t{k}", lambda k=k: [k]) for k in range(5)]
    assert common.process_cache("t4", lambda: None) is made[4]
    assert common.process_cache("t0", lambda: "again") == "again"
