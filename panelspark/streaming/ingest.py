"""File streams: records are parsed, deduplicated within a watermark and appended; late rows follow first write wins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def record_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """JSON records of a landing folder, a bounded number of files at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("mode", "PERMISSIVE").json(folder)


def deduplicated(stream: DataFrame, keys: list[str], at: str, late: str = "1 day") -> DataFrame:
    """First row of each key; keys are forgotten once the watermark has passed them, so state stays bounded."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_batches(stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """The batch job on each micro-batch: batch and stream share one function."""
    return stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, at: str | None, by: str, width: str = "1 day", late: str = "1 day", column: str = "ts") -> DataFrame:
    """Rows and sum of ``value`` for each window and group, final once the watermark has passed.

    ``at`` sets a watermark on that column; without it the stream has one already (of a deduplication before), on ``column``.
    """
    marked = stream.withWatermark(at, late) if at else stream
    return marked.groupBy(F.window(at or column, width).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", by, "n", "total")
