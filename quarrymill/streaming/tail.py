"""Structured Streaming: following logs, windowed counts with late data, sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def follow(spark: SparkSession, path: str, schema: str, files_each_time: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each_time).parquet(path)


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(event_type, start, events, total) of tumbling windows on ts; rows that come later than `late` behind the newest are left out on a stream."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counted = marked.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return counted.select("event_type", F.col("w.start").alias("start"), "events", "total")


def session_counts(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """(user_id, start, end, events): runs of a user's events with no pause of `gap` or more."""
    marked = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    counted = marked.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return counted.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def drain(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Hands all that has arrived to `write`, batch by batch, and stops; a later call with the same checkpoint goes on where this one ended."""
    started = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started
