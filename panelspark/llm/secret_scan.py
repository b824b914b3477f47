"""Secret scans through an incremental blob ledger, with DataFrame functions only.

Every version of a document is addressed by its content (SHA-256). The ledger remembers which blobs were scanned with
which rule version; a scan reads only unseen pairs, one row for each unseen blob, appends its findings to the ledger and
joins them back to all rows (paths) that carry the blob.

A rule matches leftmost and without overlap; a match is a finding if its measured group is long enough. Spans are in code
points, end exclusive. Rule version 1 is the base (assign, access, hex); version 2 adds tokens of a code host and headers
of private keys, and never takes a base span away.

Defined cases: null text counts as empty; empty text and texts without a finding have no spans; texts of any length are
scanned whole; repeated rows get the same findings; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.llm._common import discard, key_filter, maybe_among, shared_dir, stash


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    measured: str  # the pattern, of the whole match, whose group 1 is measured
    least: int


ASSIGN = r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
RULES = (
    Rule("assign", 1, ASSIGN, ASSIGN_VALUE, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", r"^(.*)$", 16),
    Rule("hex", 1, r"[0-9a-f]{32,}", r"^(.*)$", 32),
    Rule("host", 2, r"gh[opsur]_[A-Za-z0-9]{36,}", r"^(.*)$", 40),
    Rule("pem", 2, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"^(.*)$", 1),
)


class BlobLedger:
    """Scanned (blob, rule version) pairs and their findings, as Parquet under ``path``."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules = spark, rules
        self.path = path or f"{shared_dir(spark)}/blob-ledger-{uuid.uuid4().hex}"

    def _read(self, table: str, schema: str) -> DataFrame:
        reader = self.spark.read.schema(schema)
        path = f"{self.path}/{table}"
        jvm = self.spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        there = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
        return reader.parquet(path) if there else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob binary, version int")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob binary, version int, kind string, start long, end long")

    def scan(self, docs: DataFrame) -> DataFrame:
        """Scan what is unseen in ``docs``; (doc_id, blob) of all its rows."""
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("blob"))
        paths = stash(rows.select("doc_id", "blob"), "paths")
        blobs = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
        scanned, found, versions = self.scanned(), None, sorted({r.version for r in self.rules})
        marked = rows
        unseen = {}
        for v in versions:
            unseen[v] = stash(blobs.join(scanned.filter(F.col("version") == v), "blob", "left_anti"), "unseen")
        for v in versions:
            # One row of each unseen blob; a false positive of the filter is scanned once more and merged below.
            at = unseen[v].select(F.xxhash64("blob", "doc_id").alias("at"))
            marked = maybe_among(marked.withColumn("at", F.xxhash64("blob", "doc_id")), "at", key_filter(at, "at", unseen[v].count())).withColumnRenamed("_maybe", f"scan_{v}").drop("at")
        for v in versions:
            own = [r for r in self.rules if r.version == v]
            hit = F.lit(False)
            for r in own:
                hit = hit | F.col("text").rlike(r.pattern)
            marked = marked.withColumn(f"hit_{v}", F.when(F.col(f"scan_{v}"), hit).otherwise(F.lit(False)))
        any_hit = F.lit(False)
        for v in versions:
            any_hit = any_hit | F.col(f"hit_{v}")
        some = marked.filter(any_hit).groupBy("blob").agg(F.first("text").alias("text"), *(F.max(f"hit_{v}").alias(f"hit_{v}") for v in versions))
        found = _spans(some, self.rules)
        found.write.mode("append").parquet(f"{self.path}/findings")
        for v in versions:
            unseen[v].select("blob", F.lit(v).cast("int").alias("version")).write.mode("append").parquet(f"{self.path}/scanned")
        discard(self.spark, *unseen.values())
        return paths

    def report(self, paths: DataFrame) -> DataFrame:
        """doc_id, blob and findings array<struct<start, rank, kind, end>> (by start, then by rule) of every row of ``paths``."""
        rank = F.lit(len(self.rules))
        for k, r in enumerate(self.rules):
            rank = F.when(F.col("kind") == r.kind, k).otherwise(rank)
        kinds = self.spark.createDataFrame([(r.kind, r.version) for r in self.rules], "kind string, version int")
        own = self.findings().join(F.broadcast(kinds), ["kind", "version"])
        each = own.groupBy("blob").agg(F.sort_array(F.collect_set(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("findings"))
        return paths.join(each, "blob", "left").withColumn("findings", F.coalesce("findings", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")))


def _spans(some: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings (blob, version, kind, start, end) of the texts: what stands between matches, and the matches, give the places."""
    def one(r: Rule) -> Column:
        between, hits = F.split("text", r.pattern, -1), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))
        steps = F.zip_with(F.slice(between, F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(F.char_length(gap).cast("long").alias("gap"), F.char_length(hit).cast("long").alias("size"), (F.char_length(F.regexp_extract(hit, r.measured, 1)) >= r.least).alias("good")))
        return F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).cast("int").alias("version"), F.when(F.col(f"hit_{r.version}"), steps).alias("steps"))

    each = some.select("blob", F.explode(F.array(*(one(r) for r in rules))).alias("r")).select("blob", "r.kind", "r.version", F.posexplode("r.steps").alias("nth", "m"))
    upto = Window.partitionBy("blob", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    ends = each.select("blob", "version", "kind", F.col("m.size").alias("size"), F.col("m.good").alias("good"), F.sum(F.col("m.gap") + F.col("m.size")).over(upto).alias("end"))
    return ends.filter("good").select("blob", "version", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def scan_secrets(docs: DataFrame, ledger: BlobLedger | None = None) -> DataFrame:
    """doc_id, blob, findings for every row of ``docs``; with a ledger that exists only what it has not seen is scanned."""
    ledger = ledger or BlobLedger(docs.sparkSession)
    return ledger.report(ledger.scan(docs))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every finding of its texts replaced by ``mask``; all columns and rows stay.

    Only rows that have a finding are joined with their spans; overlapping spans are replaced as one.
    """
    found = stash(scan_secrets(docs).filter(F.size("findings") > 0).select("blob", "findings").dropDuplicates(["blob"]), "secrets")
    key = docs.withColumn("_secret_at", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    marked = maybe_among(key, "_secret_at", key_filter(found, "blob", found.count())).withColumnRenamed("_maybe", "_secret_may")
    clean = marked.filter(~F.col("_secret_may")).select(*docs.columns)
    rest = marked.filter("_secret_may").join(found.select(F.col("blob").alias("_secret_at"), F.col("findings").alias("_secret_spans")), "_secret_at", "left")
    spans = F.coalesce("_secret_spans", F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>"))
    # Spans are in order: each contributes the mask and the text up to the next start; what an earlier span covers is skipped.
    state = F.aggregate(spans, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), lambda acc, s: F.struct(F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mask))).otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], s["end"]).alias("at")))
    done = rest.withColumn("_secret_state", state).withColumn("text", F.when(F.size(spans) == 0, F.col("text")).otherwise(F.concat("_secret_state.out", F.expr("substring(text, cast(_secret_state.at + 1 as int))"))))
    return clean.unionByName(done.select(*docs.columns))
