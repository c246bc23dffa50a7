"""Event stream jobs (an addition: the domain itself works in daily batches).

Late events are admitted up to a watermark; state is bounded by it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestride.sources.readers import EVENT_SCHEMA


def event_stream(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of events as they arrive; the time column is a timestamp."""
    raw = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_spend(events: DataFrame, window: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Events and value per window and type; closed windows are appended after the watermark."""
    spans = F.window("ts", window, slide) if slide else F.window("ts", window)
    grouped = events.withWatermark("ts", late).groupBy(spans.alias("w"), "event_type")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("w.start", "w.end", "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """Sessions of each user: runs of events at most ``gap`` apart."""
    grouped = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("s"), "user_id")
    return grouped.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def run_available(df: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Processes what has arrived and ends; ``batch`` gets each micro-batch once per checkpoint."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
    query.awaitTermination()
    return query
