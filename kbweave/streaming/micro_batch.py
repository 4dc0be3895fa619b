"""Recurring intake under Structured Streaming, and event windows as a Spark-native extra."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def ingest_stream(pages: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each micro-batch of new pages is one run; the batch id makes a repeated batch recognisable, so that `process` can be idempotent."""
    writer = pages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def event_windows(events: DataFrame, ts: str = "ts", late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts by tumbling window and type; the same plan over a table or a stream."""
    timed = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    timed = timed.withWatermark("__ts", late) if events.isStreaming else timed
    return timed.groupBy(F.window("__ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
