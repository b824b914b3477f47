"""Keyed writes on Parquet tables (one writer at a time): each gives the table's new content as a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, keys: list[str], order: list[Column], last: bool = False) -> DataFrame:
    """One row for each key: the first in the order (or the last)."""
    way = [c.desc() for c in order] if last else order
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*way))).filter("_nth = 1").drop("_nth")


def fit_columns(df: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns, cast to its types; those that ``df`` lacks are missing, others are left out."""
    return df.select(*((F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in target.dtypes))


def insert_if_absent(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First write wins, in the batch and against the target."""
    new = first_by_key(batch, keys, order).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fit_columns(new, target))


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column], update: list[str] | None = None) -> DataFrame:
    """The last batch row of a key replaces the target's columns (all but the keys, or those in ``update``); new keys are added."""
    update = update or [c for c in target.columns if c not in keys and c in batch.columns]
    last = first_by_key(batch, keys, order, last=True)
    came = last.select(*keys, F.lit(True).alias("_came"), *(F.col(c).alias(f"_new_{c}") for c in target.columns if c not in keys and c in batch.columns))
    both = target.withColumn("_here", F.lit(True)).join(came, keys, "full")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in batch.columns:
            changed = F.col("_came").isNotNull() if c in update else F.col("_here").isNull()
            out.append(F.when(changed, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return both.select(*out)


def versions(history: DataFrame, keys: list[str], at: str, tracked: list[str]) -> DataFrame:
    """Slowly changing dimension: one row for each stretch of equal tracked columns, with valid_from, valid_to and version.

    ``history`` has a row for each observation; an open stretch has no valid_to.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    state = F.struct(*tracked)
    turns = history.withColumn("_before", F.lag(state).over(w)).filter(F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before")))
    return turns.select(*keys, *tracked, F.col(at).alias("valid_from"), F.lead(at).over(w).alias("valid_to"), F.row_number().over(w).alias("version"))


def forward_adjusted(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Prices times the adjustment factor over the entity's last one; ``factors`` is (entity, dt, adj_factor)."""
    both = bars.join(factors, ["entity", "dt"])
    last = F.last("adj_factor").over(Window.partitionBy("entity").orderBy("dt").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return both.select("entity", "dt", *((F.col(c) * F.col("adj_factor") / last).alias(f"{c}_adj") for c in ("open", "high", "low", "close")), "volume", "amount", "adj_factor")


def resample(bars: DataFrame, unit: str) -> DataFrame:
    """Bars of a longer period (week, month, quarter, year), dated by its first day."""
    out = bars.groupBy("entity", F.to_date(F.date_trunc(unit, "dt")).alias("period"))
    return out.agg(F.min_by("open", "dt").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "dt").alias("close"), F.sum("volume").alias("volume"), F.sum("amount").alias("amount"))


def curated_bars(raw: DataFrame, symbol: str, timeframe: str, curated: DataFrame | None = None) -> DataFrame:
    """(timestamp, timeframe, open .. volume): the bars of one symbol and timeframe that are not in ``curated`` yet, after it.

    What is curated stays as it is; of raw bars of one time the first by exchange is taken.
    """
    columns = ["timestamp", "timeframe", "open", "high", "low", "close", "volume"]
    chosen = raw.filter((F.col("symbol") == symbol) & (F.col("timeframe") == timeframe))
    target = raw.select(*columns).limit(0) if curated is None else curated
    return insert_if_absent(target, chosen, ["timestamp", "timeframe"], [F.col("exchange"), F.col("close")])


def latest_by(df: DataFrame, keys: list[str], at: str) -> DataFrame:
    """The latest row of each key, as of column ``at``."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), at).alias("_b"))
    return best.select(*keys, *(F.col(f"_b.{c}").alias(c) for c in rest))


def above_watermark(df: DataFrame, at: str, mark) -> DataFrame:
    """Rows after the last stored mark (all where there is none)."""
    return df if mark is None else df.filter(F.col(at) > F.lit(mark))


def calendar(spark: SparkSession, start: str, end: str, kind: str = "day") -> DataFrame:
    """(dt): days, weekdays, month ends or quarter ends from start to end."""
    step = {"day": "1 day", "weekday": "1 day", "month": "1 month", "quarter": "3 months"}[kind]
    first = {"month": "month", "quarter": "quarter"}.get(kind)
    begin = F.date_trunc(first, F.lit(start).cast("date")).cast("date") if first else F.lit(start).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(begin, F.lit(end).cast("date"), F.expr(f"interval {step}"))).alias("dt"))
    if kind == "weekday":
        return days.filter(~F.dayofweek("dt").isin(1, 7))
    if kind == "day":
        return days
    months = 1 if kind == "month" else 3
    return days.select(F.last_day(F.add_months("dt", months - 1)).alias("dt")).filter(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def missing_dates(days: DataFrame, present: DataFrame, column: str = "dt") -> DataFrame:
    """Calendar days that a table has no row of."""
    return days.join(present.select(F.col(column).alias("dt")).distinct(), "dt", "left_anti")


def inventory(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(table, n_rows, n_keys, first, last) of each table, given its key and its date column: one pass over each."""
    out = None
    for name, (df, key, at) in tables.items():
        one = df.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_keys"), F.min(at).cast("string").alias("first"), F.max(at).cast("string").alias("last")).select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def export_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Write as Parquet; the number of rows comes from the write itself, which is the only run of the plan. Of an empty table
    nothing stays."""
    seen = Observation("export")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    n = int(seen.get["n"])
    if not n:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    return n


def run_job(name: str, read: Callable[[], DataFrame], validate: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], int], log_path: str | None = None) -> dict:
    """Collect, validate and store; a row of the audit log for each run, also for one that failed.

    ``write`` must run the plan it is given: the rows fetched are counted while it does. After a failure they are counted anew.
    """
    import time

    started, fetched = time.time(), None
    row = {"pipeline_name": name, "status": "ok", "records_fetched": 0, "records_written": 0, "error_message": None}
    spark = SparkSession.active()
    try:
        fetched, seen = read(), Observation(f"fetched {name}")
        row["records_written"] = write(validate(fetched.observe(seen, F.count(F.lit(1)).alias("n"))))
        row["records_fetched"] = int(seen.get["n"])
    except Exception as e:  # the log keeps what went wrong; the caller sees it as well
        if fetched is not None:
            row["records_fetched"] = fetched.count()
        row |= {"status": "failed", "error_message": str(e)[:500]}
        raise
    finally:
        row["duration_seconds"] = time.time() - started
        if log_path:
            schema = "pipeline_name string, status string, records_fetched long, records_written long, error_message string, duration_seconds double"
            spark.createDataFrame([row], schema).write.mode("append").parquet(log_path)
    return row
