"""Structured Streaming forms of the incremental jobs.

The store's jobs are batches over what is new since a watermark or missing from a
ledger.  Over a stream the checkpoint takes the watermark's place, and writes stay
idempotent by their keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def windowed_tally(events: DataFrame, size: str = "6 hours", slide: str | None = None, late: str = "1 day", time: str = "created_at") -> DataFrame:
    """Cited and surfaced recalls by memory in tumbling (or sliding) event-time windows; later rows than ``late`` are dropped by the watermark."""
    window = F.window(time, size, slide) if slide else F.window(time, size)
    counted = events.withWatermark(time, late).groupBy(window.alias("window"), "memory_id").agg(F.count_if("cited").alias("cited_count"), F.count("*").alias("surfaced_count"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "memory_id", "cited_count", "surfaced_count")


def session_tally(events: DataFrame, gap: str = "30 minutes", late: str = "1 day", time: str = "created_at") -> DataFrame:
    """Recalls by memory in sessions that end after a gap."""
    counted = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("window"), "memory_id").agg(F.count("*").alias("surfaced_count"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "memory_id", "surfaced_count")


def first_seen(events: DataFrame, keys: list[str], late: str = "1 day", time: str = "created_at") -> DataFrame:
    """Each key once within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def drain(stream: DataFrame, job: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``job(batch, batch_id)`` over everything that is there, then stop; a batch that is repeated has the same id."""
    return stream.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_once(path: str, key: str) -> Callable[[DataFrame, int], None]:
    """A sink that appends rows whose key is not in the table yet, each batch in its own partition, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        hadoop = spark._jsc.hadoopConfiguration()
        root = spark._jvm.org.apache.hadoop.fs.Path(path)
        if root.getFileSystem(hadoop).exists(root):
            seen = spark.read.parquet(path).where(F.col("batch_id") != batch_id).select(key)
            fresh = fresh.join(seen, key, "left_anti")
        fresh.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write
