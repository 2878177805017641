"""Incremental runs: new files once, late events by watermark, sessions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire import schemas
from quire.sources.readers import stem


def new_items(spark: SparkSession, path: str) -> DataFrame:
    """Layout items of files as a stream; each file is read once per checkpoint."""
    text = spark.readStream.schema("value string").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*_content_list.json").text(path)
    named = text.select(stem(F.col("_metadata.file_path"), "_content_list.json").alias("doc_id"), F.col("_metadata.file_path").alias("source_file"), "value")
    items = named.select("doc_id", "source_file", F.posexplode(F.from_json("value", f"array<{schemas.ITEM}>")).alias("idx", "item"))
    return items.where("item is not null").select("doc_id", "source_file", "idx", "item.*")


def run_once(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Handles what is new since the last run, in batches, and stops.

    A new version of the handling needs a new checkpoint, which reads all files again.
    """
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def tumbling(events: DataFrame, size: str, late: str | None = None, ts: str = "ts") -> DataFrame:
    """Counts and sums by window and type; a stream drops events later than ``late``."""
    df = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        df = df.withWatermark(ts, late)
    out = df.groupBy(F.window(ts, size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "events", "total")


def sessions(events: DataFrame, gap: str, late: str | None = None, ts: str = "ts") -> DataFrame:
    """Sessions of a user: events with less than ``gap`` between them."""
    df = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if late:
        df = df.withWatermark(ts, late)
    out = df.groupBy(F.session_window(ts, gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("events"))
    return out.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")
