"""Tables kept as partitioned Parquet: upserts of touched partitions only, incremental versions, and jobs that resume.

One writer at a time. A table is a folder whose partitions are rewritten one by one (dynamic overwrite): files of partitions
that a batch does not touch stay as they are.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.sources.store import first_by_key, fit_columns, upsert


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share; a temporary one in local mode without it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-work-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _fs(spark, path)
    return fs.exists(place)


def has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder holds data files."""
    fs, place = _fs(spark, path)
    if not fs.exists(place):
        return False
    files = fs.listFiles(place, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _delete(spark: SparkSession, *folders: str) -> None:
    for folder in folders:
        fs, place = _fs(spark, folder)
        fs.delete(place, True)


def _staged(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    """What is written over a table cannot be read from it meanwhile: it goes to a folder beside it first."""
    spark, aside = df.sparkSession, f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    df.write.parquet(aside)
    return spark.read.schema(df.schema).parquet(aside), aside


def upsert_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], order: list[Column], by: list[str], update: list[str] | None = None, keep_first: bool = False) -> dict:
    """Upsert ``batch`` into the table at ``path``, partitioned by ``by`` (columns of the key): only the partitions that the
    batch has rows of are read and written. ``keep_first``: rows that are there stay, only new keys are added.

    The batch is read once and cut to one row for each key before anything is written; first and last writer inside the batch
    are settled in the same commit. Gives numbers: partitions touched, rows before and after in them.
    """
    assert set(by) <= set(keys), "a key must not move between partitions"
    new, aside = _staged(first_by_key(batch, keys, order, last=not keep_first), path)
    if not has_rows(spark, path):
        _write_partitions(new, path, by)
        figures = {"partitions": new.select(*by).distinct().count(), "before": 0, "after": new.count()}
        _delete(spark, aside)
        return figures
    target = spark.read.parquet(path)
    touched = new.select(*by).distinct()
    # Partition values are few against the rows; the semi join with them prunes the scan to touched partitions.
    old = target.join(F.broadcast(touched), by, "left_semi")
    if keep_first:
        added = new.join(old.select(*keys), keys, "left_anti")
        merged = old.unionByName(fit_columns(added, target))
    else:
        merged = upsert(old, new, keys, order, update)
    counts = old.agg(F.count("*").alias("n")).first()
    result, second = _staged(merged, path)
    figures = {"partitions": touched.count(), "before": int(counts["n"]), "after": result.count()}
    _write_partitions(result, path, by)
    _delete(spark, aside, second)
    return figures


def build_versions(history: DataFrame, keys: list[str], at: str, tracked: list[str]) -> DataFrame:
    """``store.versions`` with ``seen_to``, the last time at which a stretch was observed. A key has one observation a time."""
    w = Window.partitionBy(*keys).orderBy(at)
    state = F.struct(*tracked)
    turn = F.when(F.lag(state).over(w).eqNullSafe(state), 0).otherwise(1)
    stretch = history.select(*keys, at, *tracked, turn.alias("_turn")).withColumn("version", F.sum("_turn").over(w).cast("int"))
    spans = stretch.groupBy(*keys, "version").agg(F.min(F.struct(at, *tracked)).alias("_first"), F.max(at).alias("seen_to"))
    start = F.col(f"_first.{at}")
    own = Window.partitionBy(*keys).orderBy("version")
    return spans.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in tracked), start.alias("valid_from"), F.lead(start).over(own).alias("valid_to"), "version", "seen_to")


def merge_versions(current: DataFrame, batch: DataFrame, history: DataFrame, keys: list[str], at: str, tracked: list[str]) -> DataFrame:
    """A versioned table (from ``build_versions``) after more observations; equal to one build of all of them.

    Keys without news pass through. Where a key's news all come after what is known of it, they are compared with its open
    row only: an equal one prolongs it, another closes it and opens the next. A key with a late observation is built again from
    ``history`` (the observations before this batch), as the stretches do not tell when they were seen in between.
    """
    observed = [*keys, at, *tracked]
    came = batch.select(*observed)
    last = current.filter("valid_to is null").select(*keys, "valid_from", "seen_to", F.col("version").alias("_v"), *(F.col(c).alias(f"_{c}") for c in tracked))
    touched = came.select(*keys).distinct()
    late = came.join(last.select(*keys, "seen_to"), keys).filter(F.col(at) <= F.col("seen_to")).select(*keys).distinct()
    timely = touched.join(late, keys, "left_anti")
    again = build_versions(history.select(*observed).join(late, keys, "left_semi").unionByName(came.join(late, keys, "left_semi")), keys, at, tracked)
    # The open row as the two observations that bound it.
    open_rows = last.join(timely, keys, "left_semi")
    bounds = open_rows.select(*keys, F.explode(F.array_distinct(F.array("valid_from", "seen_to"))).alias(at), *(F.col(f"_{c}").alias(c) for c in tracked))
    grown = build_versions(bounds.unionByName(came.join(timely, keys, "left_semi")), keys, at, tracked)
    grown = grown.join(open_rows.select(*keys, "_v"), keys, "left").withColumn("version", (F.col("version") + F.coalesce("_v", F.lit(1)) - 1).cast("int")).drop("_v")
    closed = current.filter("valid_to is not null").join(timely, keys, "left_semi")
    rest = current.join(touched, keys, "left_anti")
    out = rest
    for part in (closed, grown, again):
        out = out.unionByName(part.select(*current.columns))
    return out


# ---- jobs that resume ---------------------------------------------------------------------------------------------------------

_STATE = "job string, run_id string, mark string, rows_total long, runs long"


class JobState:
    """How far a job has come: one small JSON file, replaced by a rename, so that it holds either the old or the new state."""

    def __init__(self, spark: SparkSession, folder: str, job: str):
        self.spark, self.path, self.job = spark, f"{folder.rstrip('/')}/{job}.json", job

    def read(self) -> dict:
        """The last state; an empty one before the first run."""
        if not exists(self.spark, self.path):
            return {"job": self.job, "run_id": None, "mark": None, "rows_total": 0, "runs": 0}
        return self.spark.read.schema(_STATE).json(self.path).first().asDict()

    def replace(self, state: dict) -> None:
        import json

        fs, place = _fs(self.spark, self.path)
        fresh = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}.{state['run_id']}")
        out = fs.create(fresh, True)
        out.write(bytearray((json.dumps(state) + "\n").encode()))
        out.close()
        # Hadoop's FileContext replaces the target in one step.
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        option = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = option
        context.rename(fs.makeQualified(fresh), fs.makeQualified(place), options)


def resume_job(spark: SparkSession, state: JobState, source: DataFrame, at: str, path: str, keys: list[str], by: list[str], before_commit: Callable[[], None] | None = None) -> dict:
    """One run: the rows of ``source`` above the stored mark go into the table at ``path``; then the mark moves to the largest
    ``at`` among them. Gives the new state, with ``rows`` of this run.

    Rows are added by key, the stored one stays, and the mark is replaced last: a run that fails between the write and the
    commit is repeated by the next one, which finds its rows by key and adds none twice; one that fails before the write has
    left nothing. ``at`` must order the source as text or number does; rows without it are not taken. ``before_commit`` is
    called between the two steps.
    """
    last = state.read()
    fresh = source.filter(F.col(at).isNotNull())
    if last["mark"] is not None:
        fresh = fresh.filter(F.col(at) > F.lit(last["mark"]).cast(source.schema[at].dataType))
    run_id = uuid.uuid4().hex
    came, aside = _staged(fresh, path)  # the only read of the source
    found = came.agg(F.count("*").alias("n"), F.max(at).cast("string").alias("mark")).first()
    upsert_partitions(spark, path, came, keys, [F.col(at)], by, keep_first=True)
    _delete(spark, aside)
    if before_commit:
        before_commit()
    n = int(found["n"])
    after = {"job": state.job, "run_id": run_id, "mark": found["mark"] if n else last["mark"], "rows_total": last["rows_total"] + n, "runs": last["runs"] + 1}
    state.replace(after)
    return after | {"rows": n}


# ---- one pass to many sinks ------------------------------------------------------------------------------------------------------


def route_once(df: DataFrame, shapes: dict[str, list[str]], required: dict[str, list[str]], numeric: dict[str, list[str]], path: str, other: str = "other") -> dict[str, dict[str, int]]:
    """Records to their sinks in one pass over the source: a folder for each ``sink`` and ``valid``, written by one job.

    The sink is the first shape whose fields a record has; a record is valid if it has what its sink requires and its numbers
    can be read, otherwise it goes to quarantine (``valid=false``) with its ``errors``. Gives the rows of each sink by
    validity, counted by the write itself.
    """
    from panelspark.sources.parse import validated
    from panelspark.sources.readers import routed

    marked = routed(df, shapes, other)
    errors = F.array().cast("array<string>")
    for sink in shapes:
        checked = validated(marked, required.get(sink, []), numeric.get(sink, []))
        marked = checked.withColumnRenamed("errors", f"_errors_{sink}")
        errors = F.when(F.col("sink") == sink, F.col(f"_errors_{sink}")).otherwise(errors)
    marked = marked.withColumn("errors", errors).drop(*(f"_errors_{s}" for s in shapes)).withColumn("valid", F.size("errors") == 0)
    seen = Observation("routed")
    sinks = [*shapes, other]
    tally = [F.count(F.when((F.col("sink") == s) & (F.col("valid") == v), 1)).alias(f"{s}|{v}") for s in sinks for v in (True, False)]
    marked.observe(seen, *tally).write.mode("overwrite").partitionBy("sink", "valid").parquet(path)
    found = seen.get
    return {s: {"valid": int(found[f"{s}|True"]), "quarantine": int(found[f"{s}|False"])} for s in sinks}


# ---- landing files ------------------------------------------------------------------------------------------------------------------


def read_landing(spark: SparkSession, folder: str, target: DataFrame, form: str = "json") -> DataFrame:
    """Vendor files (JSON lines or CSV with a header) of a landing folder under the target's columns and types, with
    ``_damaged`` (the line, where it cannot be read as a record) and ``_file``.

    Fields that the target lacks are left out and columns that the files lack are missing (files of an older or newer shape
    go together, CSV columns by the names of each file's header); a field that cannot be read as the target's type is missing
    in its row, and the row counts as damaged. A record is one line; blank lines are none.
    """
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_path").alias("_file")).filter(F.trim("value") != "")
    keep = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"}
    kinds = dict(target.dtypes)
    if form == "json":
        schema = ", ".join(f"`{c}` {t}" for c, t in target.dtypes) + ", _damaged string"
        return lines.select(F.from_json("value", schema, keep).alias("r"), "_file").select(*(F.col(f"r.{c}").alias(c) for c in target.columns), "r._damaged", "_file")
    out = None
    for header in _headers(lines):
        names = header.split(",")
        schema = ", ".join(f"`{c}` {kinds.get(c, 'string')}" for c in names) + ", _damaged string"
        own = lines.join(_first_lines(lines).filter(F.col("header") == header).select("_file"), "_file", "left_semi").filter(F.col("value") != header)
        part = own.select(F.from_csv("value", schema, keep).alias("r"), "_file")
        cells = [(F.col(f"r.{c}") if c in names else F.lit(None).cast(t)).alias(c) for c, t in target.dtypes]
        part = part.select(*cells, "r._damaged", "_file")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else target.limit(0).select("*", F.lit(None).cast("string").alias("_damaged"), F.lit(None).cast("string").alias("_file"))


def _first_lines(lines: DataFrame) -> DataFrame:
    """(_file, header): the first line of each file."""
    return lines.withColumn("_at", F.monotonically_increasing_id()).groupBy("_file").agg(F.min_by("value", "_at").alias("header"))


def _headers(lines: DataFrame) -> list[str]:
    """The headers of the files: as many as there are shapes."""
    return [r["header"] for r in _first_lines(lines).select("header").distinct().orderBy("header").collect()]


def damage(rows: DataFrame) -> DataFrame:
    """(file, n_rows, n_damaged) of what ``read_landing`` gave."""
    return rows.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("n_rows"), F.count("_damaged").alias("n_damaged"))
