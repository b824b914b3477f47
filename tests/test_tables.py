"""Upserts by partition, versions in batches, jobs that resume, routing, landing files, streams and isolated factor jobs."""

from __future__ import annotations

import os
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from panelspark.expr import apply, measure
from panelspark.factors import registry
from panelspark.factors.registry import Factor
from panelspark.sources import tables
from panelspark.streaming import ingest


def _files(path):
    return {os.path.join(d, f)[len(str(path)) :] for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k int, day string, v int, w string, n int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    args = (["k", "day"], [F.col("n")], ["day"])
    assert tables.upsert_partitions(spark, path, frame([]), *args)["after"] == 0
    tables.upsert_partitions(spark, path, frame([(1, "a", 1, "x", 0), (2, "a", 2, "x", 0), (1, "b", 3, "x", 0), (1, "c", 4, "x", 0)]), *args)
    before = _files(path)
    figures = tables.upsert_partitions(spark, path, frame([(1, "b", 9, "y", 1), (1, "b", 10, "z", 2), (5, "b", 5, None, 1), (1, "d", 6, "x", 1)]), *args)
    assert figures == {"partitions": 2, "before": 1, "after": 3}
    same = {f for f in before if "day=a" in f or "day=c" in f}
    assert same and same <= _files(path) and not {f for f in before if "day=b" in f} & _files(path)
    rows = lambda: sorted((r["k"], r["day"], r["v"], r["w"]) for r in spark.read.parquet(path).collect())
    assert rows() == [(1, "a", 1, "x"), (1, "b", 10, "z"), (1, "c", 4, "x"), (1, "d", 6, "x"), (2, "a", 2, "x"), (5, "b", 5, None)]
    tables.upsert_partitions(spark, path, frame([(1, "a", 100, "q", 3), (7, "a", 7, "q", 3)]), *args, keep_first=True)
    assert (1, "a", 1, "x") in rows() and (7, "a", 7, "q") in rows()
    tables.upsert_partitions(spark, path, frame([(1, "a", 50, "new", 4)]), *args, update=["v"])
    assert (1, "a", 50, "x") in rows() and len(os.listdir(tmp_path)) == 1


@pytest.mark.parametrize("seed", range(3))
def test_versions_in_batches_equal_one_build(spark, seed):
    rng = random.Random(seed)
    seen = [(k, date(2024, 1, d), rng.choice(["a", "b", None]), rng.choice([1, None])) for k in (*range(6), None) for d in range(1, 29) if rng.random() < 0.5]
    schema = "k int, day date, s string, x int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    args = (["k"], "day", ["s", "x"])
    seen = [r for r in seen if r[0] is not None]
    rng.shuffle(seen)
    early = sorted(seen[:30], key=lambda r: r[1])
    later = [r for r in seen[30:] if r[0] in (0, 1)]  # late and timely ones of some keys
    rest = [r for r in seen[30:] if r[0] not in (0, 1)]
    now, known = tables.build_versions(frame(early), *args), early
    for batch in (later, rest, []):
        now = spark.createDataFrame(tables.merge_versions(now, frame(batch), frame(known), *args).collect(), now.schema)
        known = known + batch
    whole = tables.build_versions(frame(known), *args)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, now.collect()), key=key) == sorted(map(tuple, whole.collect()), key=key)


def test_a_failed_run_neither_skips_nor_repeats(spark, tmp_path):
    state = tables.JobState(spark, str(tmp_path / "state"), "feed")
    path = str(tmp_path / "table")
    source = spark.range(1, 11).select("id", (F.col("id") % 3).cast("string").alias("part"))
    args = lambda upto: (spark, state, source.filter(F.col("id") <= upto), "id", path, ["id", "part"], ["part"])
    assert state.read()["mark"] is None
    first = tables.resume_job(*args(4))
    assert (first["mark"], first["rows"], first["rows_total"]) == ("4", 4, 4)

    def fail():
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        tables.resume_job(*args(8), before_commit=fail)
    assert state.read()["mark"] == "4" and spark.read.parquet(path).count() == 8
    broken = source.filter("id <= 8").withColumn("part", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        tables.resume_job(spark, state, broken, "id", path, ["id", "part"], ["part"])
    assert state.read() == {k: v for k, v in first.items() if k != "rows"} and spark.read.parquet(path).count() == 8
    again = tables.resume_job(*args(8))
    assert (again["mark"], again["rows"], again["rows_total"], again["runs"]) == ("8", 4, 8, 2)
    nothing = tables.resume_job(*args(8))
    assert (nothing["mark"], nothing["rows"], nothing["runs"]) == ("8", 0, 3)
    tables.resume_job(*args(10))
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(1, 11))


def test_one_scan_feeds_all_sinks(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame([("1", None, "p"), ("x", None, "q"), (None, "u", None), (None, "v", "r"), (None, None, None)], "amount string, page string, place string").write.parquet(source)
    out = str(tmp_path / "out")
    found = tables.route_once(spark.read.parquet(source), {"bought": ["amount"], "seen": ["page"]}, {"seen": ["place"]}, {"bought": ["amount"]}, out)
    assert found == {"bought": {"valid": 1, "quarantine": 1}, "seen": {"valid": 1, "quarantine": 1}, "other": {"valid": 1, "quarantine": 0}}
    bad = spark.read.parquet(out).filter("valid = 'false'").collect()
    assert {(r["sink"], r["errors"][0]) for r in bad} == {("bought", "amount is not a number"), ("seen", "place is missing")}


def test_landing_files_of_several_shapes(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "name": "x", "extra": 5}\n{"id": 2, "na\n')
    (folder / "b.json").write_text('{"id": "three"}\n\n{"id": 4, "price": 1.5}\n')
    target = spark.createDataFrame([], "id int, name string, price double")
    rows = tables.read_landing(spark, str(folder), target)
    assert rows.columns == ["id", "name", "price", "_damaged", "_file"]
    assert sorted((r["id"] or 0, r["name"], r["price"], r["_damaged"] is not None) for r in rows.collect()) == [(0, None, None, True), (0, None, None, True), (1, "x", None, False), (4, None, 1.5, False)]
    assert sorted((r["file"][-6:], r["n_rows"], r["n_damaged"]) for r in tables.damage(rows).collect()) == [("a.json", 2, 1), ("b.json", 2, 1)]
    sheets = tmp_path / "csv"
    sheets.mkdir()
    (sheets / "a.csv").write_text("id,name\n1,x\nbad,y\n")
    (sheets / "b.csv").write_text("price,id,extra\n2.5,2,e\n")
    got = tables.read_landing(spark, str(sheets), target, "csv").collect()
    assert sorted((r["id"] or 0, r["name"], r["price"], r["_damaged"] is not None) for r in got) == [(0, "y", None, True), (1, "x", None, False), (2, None, 2.5, False)]


def test_stream_drops_what_is_too_late_and_restarts(spark, tmp_path):
    landing, out = str(tmp_path / "landing"), str(tmp_path / "out")
    schema = "event_id long, ts timestamp, event_type string, value double"

    def deliver(rows):
        spark.createDataFrame([(i, t, k, v) for i, t, k, v in rows], "event_id long, ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        counts = ingest.windowed_counts(ingest.deduplicated(stream, ["event_id"], "ts", "1 day"), None, "event_type")
        ingest.append_to(counts, out, str(tmp_path / "checkpoint")).awaitTermination()

    deliver([(1, "2024-01-01 10:00", "a", 1.0), (2, "2024-01-01 11:00", "a", 2.0)])
    deliver([(3, "2024-01-02 09:00", "a", 4.0), (1, "2024-01-01 10:00", "a", 1.0)])  # one comes twice
    run()
    deliver([(4, "2024-01-01 23:00", "a", 8.0), (5, "2024-01-06 00:00", "a", 16.0)])  # late, within the bound
    deliver([(8, "2024-01-06 01:00", "b", 0.0)])  # late rows are told by the watermark of the batch before
    deliver([(6, "2024-01-01 12:00", "a", 100.0), (7, "2100-01-01", "end", 0.0)])  # too late
    run()
    got = sorted((str(r["start"])[:10], r["n"], r["total"]) for r in spark.read.parquet(out).filter("event_type = 'a'").collect())
    assert got == [("2024-01-01", 3, 11.0), ("2024-01-02", 1, 4.0), ("2024-01-06", 1, 16.0)]


def test_a_broken_factor_stops_no_other(spark, tmp_path):
    panel = spark.createDataFrame([(e, date(2024, 1, d), 1.0 * d * e) for e in (1, 2) for d in range(1, 6)], "entity int, dt date, close double")
    close = measure("close")
    raising = apply("raising", lambda c: F.when(c > 3, F.raise_error(F.lit("no value")).cast("double")).otherwise(c), close)
    known = {n: Factor(n, "t", e) for n, e in {"up": close * 2, "lost": measure("nowhere") + 1, "raises": raising, "flat": close - close}.items()}
    made, failed = registry.compute_all(panel, list(known), known)
    assert made.columns == ["entity", "dt", "up", "raises", "flat"] and list(failed) == ["lost"] and "nowhere" in failed["lost"]
    path = str(tmp_path / "store")
    failed = registry.export_all(panel, list(known), path, known=known)
    assert sorted(failed) == ["lost", "raises"] and "no value" in failed["raises"]
    assert {(r["factor"], r["n"]) for r in spark.read.parquet(path).groupBy("factor").agg(F.count("*").alias("n")).collect()} == {("up", 10), ("flat", 10)}
    by_day = str(tmp_path / "by_day")
    assert registry.export_all(panel, ["up"], by_day, partition_by="dt", known=known) == {}
    assert sorted(os.listdir(by_day))[-1].startswith("dt=2024-01-0")
