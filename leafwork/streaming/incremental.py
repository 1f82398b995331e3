"""Incremental ingestion: landed files as streams, the batch plan per micro-batch, and a seen set."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landed(spark: SparkSession, path: str, schema: str, files: int = 1000) -> DataFrame:
    """Stream over Parquet files as they land; `files` bounds a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def new_rows(stream: DataFrame, key: str, event_time: str, late: str = "30 days") -> DataFrame:
    """First delivery of each key; state is dropped once the watermark has passed."""
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark([key])


def append_processed(stream: DataFrame, plan: Callable[[DataFrame], DataFrame], target: str, checkpoint: str) -> StreamingQuery:
    """Runs the batch plan on every micro-batch and writes it under its batch number.

    A batch that is run again after a failure overwrites its own folder, so results are neither lost nor doubled.
    """

    def process(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def unprocessed(rows: DataFrame, done: DataFrame, content: list[str], stage: str) -> DataFrame:
    """Rows whose content hash the stage has not seen: the skip of a stage cache, keyed by content and not by file name."""
    hashed = rows.withColumn("input_hash", F.sha2(F.concat_ws("\x1f", *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in content)), 256))
    return hashed.join(done.where(F.col("stage") == stage).select("input_hash").distinct(), "input_hash", "left_anti")


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Tumbling counts by event type, with late events up to `late` (an extra beside the document operators)."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
