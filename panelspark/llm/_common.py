"""What the operators of this subpackage share: work tables, key filters and Arrow helpers."""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of one bitmap row of ``bitmap_construct_agg`` (fixed by Spark).
BITMAP_BITS = 32768
#: A key filter has this many bits at most: 8 MB, whatever the size of the corpus.
FILTER_BITS = 1 << 26
#: Rows in one Arrow batch: keeps a batch of long texts small.
BATCH_ROWS = 500


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); a temporary one only in local mode where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-work-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed_at = path
    return out


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stashed tables that no later plan reads, and let Spark drop the shuffle files of plans that are over."""
    jvm = spark.sparkContext._jvm
    for t in tables:
        place = jvm.org.apache.hadoop.fs.Path(t.stashed_at)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    gc.collect()
    jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch for the Python steps that follow (texts can be long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def process_cache(key: str, make):
    """What ``make()`` gave when ``key`` was first asked for in this Python process: tables that tasks of a worker share.

    Only what was last used is held, so that the memory of a worker does not grow with the number of operators it served.
    """
    held = sys.modules.setdefault("_panelspark_held", types.SimpleNamespace(tables={})).tables
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once: it is bound as the variable of a lambda, which no rule takes apart."""
    return F.get(F.transform(F.array(value), body), 0)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _slot(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(bits))


def key_filter(keys: DataFrame, key: str, count: int) -> tuple[DataFrame, int]:
    """A bitmap of the hashed keys: at most FILTER_BITS / 32768 rows of 4 KB, so its broadcast has a fixed bound.

    It has false positives (more of them as it fills), no false negatives.
    """
    bits = BITMAP_BITS
    while bits < 16 * max(count, 1) and bits < FILTER_BITS:
        bits *= 2
    slot = keys.select(_slot(key, bits).alias("_slot")).select(F.expr(f"_slot div {BITMAP_BITS}").alias("_cell"), F.expr(f"_slot % {BITMAP_BITS}").alias("_bit"))
    return slot.groupBy("_cell").agg(F.bitmap_construct_agg("_bit").alias("_bits")), bits


def maybe_among(df: DataFrame, key: str, filt: tuple[DataFrame, int]) -> DataFrame:
    """``df`` with a boolean column ``_maybe``: false only where the key is certainly not among the filter's keys."""
    cells, bits = filt
    marked = df.withColumn("_slot", _slot(key, bits)).withColumn("_cell", F.expr(f"_slot div {BITMAP_BITS}"))
    joined = marked.join(F.broadcast(cells), "_cell", "left")
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast((_slot % {BITMAP_BITS}) div 8 as int) + 1, 1)), 16, 10) as int)")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(_slot % 8 as int))")) != 0
    return joined.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_slot", "_cell", "_bits")


def only_maybe(df: DataFrame, key: str, filt: tuple[DataFrame, int]) -> DataFrame:
    """The rows of ``df`` whose key may be among the filter's keys."""
    return maybe_among(df, key, filt).filter("_maybe").drop("_maybe")


#: A key that holds more than one row in so many is hot; there are never more hot keys than this.
HOT_SHARE = 1000


def meeting(rows: DataFrame, keys: list[str], counts: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined (inner, left, left_semi) with ``counts`` (keys, n, other columns), without n.

    Hot keys, at most HOT_SHARE of them, meet their rows by a broadcast; the others by a shuffle, in which the rows of hot keys
    are spread over all tasks. ``total`` is the sum of all n, or more. ``counts`` is read twice: it should be a work table.
    """
    more = [c for c in counts.columns if c not in (*keys, "n")]
    hot = counts.filter(F.col("n") * HOT_SHARE > total).select(*keys, *(F.col(c).alias(f"_hot_{c}") for c in more), F.lit(True).alias("_hot"))
    cold = counts.filter(F.col("n") * HOT_SHARE <= total).select(*keys, *(F.col(c).alias(f"_cold_{c}") for c in more), F.lit(True).alias("_cold"), F.lit(0).alias("_salt"))
    marked = rows.join(F.broadcast(hot), keys, "left")
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.hash(*rows.columns), F.lit(1 << 20)))
    met = marked.withColumn("_salt", salt).join(cold, [*keys, "_salt"], "left")
    if how != "left":
        met = met.filter(F.coalesce("_hot", "_cold"))
    return met.select(*rows.columns, *(F.coalesce(f"_hot_{c}", f"_cold_{c}").alias(c) for c in (more if how != "left_semi" else [])))


def having_key(rows: DataFrame, key: str, counts: DataFrame, total: int) -> DataFrame:
    """The rows whose key is in ``counts`` (key, n)."""
    return meeting(rows, [key], counts, total, "left_semi")
