"""Stateless ingestion and hourly counts of the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parceltide import constants as K
from parceltide.sources import topics


def start_ingest(messages: DataFrame, path: str) -> StreamingQuery:
    """Decode both topics and append them to one parquet table."""
    rows = topics.decode_messages(messages).select(
        "topic", "parcel_id", "event_id", "event_type", "event_timestamp", "hub_id",
        "planned_pickup", "planned_delivery", "problem", "value",
    )
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("path", f"{path}/messages").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).start()
    )


def usable_events(messages: DataFrame) -> DataFrame:
    return topics.decode_messages(messages).filter(
        (F.col("topic") == K.EVENT_TOPIC) & F.col("problem").isNull()
    )


def dedup_stream(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated event ids that arrive within ``delay`` of each other."""
    return events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly_counts(events: DataFrame, watermark: str | None = None) -> DataFrame:
    """Events per hour and type. Without a watermark every late event still counts, as the
    dashboard's query does; with one, old hours leave the state."""
    timed = events.withColumn("event_time", F.col("event_timestamp").cast("timestamp"))
    if watermark:
        timed = timed.withWatermark("event_time", watermark)
    return timed.groupBy(F.window("event_time", "1 hour").alias("w"), "event_type").agg(
        F.count(F.lit(1)).alias("count")
    ).select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "count")


def start_timeline(messages: DataFrame, path: str, watermark: str | None = None) -> StreamingQuery:
    """Write the counts that changed in each micro-batch; ``read_timeline`` merges them."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")

    return (
        hourly_counts(usable_events(messages), watermark).writeStream.outputMode("update")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).foreachBatch(write).start()
    )


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    """Latest count per hour and type; counts only grow."""
    return spark.read.parquet(f"{path}/counts").groupBy("hour", "event_type").agg(
        F.max("count").alias("count")
    )
