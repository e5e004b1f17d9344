"""Topic messages: Kafka options, JSON encoding and decoding, and a file stand-in for a topic.

The Kafka connector is not part of a plain Spark installation. The same functions read and
write JSON files of message rows, which is what the tests use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from parceltide import constants as K, schemas
from parceltide.functions import derive, parse

# --- fixed values: delivery guarantees of the message producers ---
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "3",
    "kafka.linger.ms": "50",
    "kafka.batch.size": "16384",
}
CONSUMED_TOPICS = (K.PLAN_TOPIC, K.EVENT_TOPIC)
_KEEP_NULLS = {"ignoreNullFields": "false"}
_BEFORE_EVENTS = -(2**62)


def kafka_messages(spark: SparkSession, servers: str, max_offsets: int = 1_000_000) -> DataFrame:
    """Stream of both topics from the earliest offset. Arrival order is the record timestamp and
    offset, so the topics should stamp records on append. A micro-batch takes at most ``max_offsets``
    records, the first one of a long topic too."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(CONSUMED_TOPICS))
        .option("startingOffsets", "earliest")
    )
    return reader.option("maxOffsetsPerTrigger", max_offsets).load().select(
        "topic", F.col("key").cast("string"), F.col("value").cast("string"),
        F.unix_micros("timestamp").alias("at_us"),
        # Equal times: plans first, then by place in the log.
        F.concat_ws("/", F.when(F.col("topic") == K.PLAN_TOPIC, "0").otherwise("1"),
                    F.lpad(F.col("partition").cast("string"), 10, "0"),
                    F.lpad(F.col("offset").cast("string"), 20, "0")).alias("at_seq"),
    )


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    writer = messages.select("key", "value").write.format("kafka")
    for name, value in {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": servers}.items():
        writer = writer.option(name, value)
    writer.option("topic", topic).save()


def stream_to_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Publish a stream of messages with the same guarantees."""
    writer = messages.select("key", "value").writeStream.format("kafka").option("topic", topic)
    for name, value in {**PRODUCER_OPTIONS, "kafka.bootstrap.servers": servers}.items():
        writer = writer.option(name, value)
    return writer.option("checkpointLocation", checkpoint).start()


def publish_files(messages: DataFrame, path: str) -> None:
    """Append message files. They are compressed, quickly rather than well: field names and keys repeat in every
    message, and a file is read by one task anyway."""
    messages.select(*schemas.TOPIC_MESSAGE.names).write.mode("append").option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED").json(path)


def read_file_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TOPIC_MESSAGE).json(path)


def stream_file_topic(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of message files, oldest files first, at most ``files_per_batch`` at a time."""
    return (
        spark.readStream.schema(schemas.TOPIC_MESSAGE)
        .option("maxFilesPerTrigger", files_per_batch).json(path)
    )


def encode_planned(planned: DataFrame, at_us: Column | None = None) -> DataFrame:
    """Plan messages keyed by parcel, published before every event unless a time is given."""
    fields = [
        (parse.iso_text(F.col(c)).alias(c) if c.startswith("planned_") else F.col(c))
        for c in schemas.PLANNED.names
    ]
    at = F.lit(_BEFORE_EVENTS) if at_us is None else at_us
    return _messages(planned, K.PLAN_TOPIC, F.struct(*fields), at, F.col("parcel_id"))


def encode_events(events: DataFrame, replayed_at: Column | None = None) -> DataFrame:
    """Canonical event messages keyed by parcel, published at ``replayed_at``, which defaults to
    the event time."""
    text = (
        F.col("event_timestamp_text") if "event_timestamp_text" in events.columns
        else parse.iso_text(F.col("event_timestamp"))
    )
    published = F.col("event_timestamp") if replayed_at is None else replayed_at
    payload = F.struct(
        "event_id", "parcel_id", "event_type", text.alias("event_timestamp"),
        "hub_id", "latitude", "longitude", parse.iso_text(published).alias("replayed_at"),
    )
    return _messages(events, K.EVENT_TOPIC, payload, derive.micros(published), F.col("event_id"))


def canonical_events(events: DataFrame) -> DataFrame:
    """The canonical event projection: repeatable id, time as ISO text, defaults filled in."""
    text = parse.iso_text(F.col("event_timestamp"))
    return events.select(
        derive.event_id(
            F.col("parcel_id"), F.col("event_type"), F.col("event_timestamp")
        ).alias("event_id"),
        "parcel_id", "event_type", text.alias("event_timestamp"),
        F.coalesce("hub_id", F.lit("")).alias("hub_id"),
        F.coalesce("latitude", F.lit(0.0)).alias("latitude"),
        F.coalesce("longitude", F.lit(0.0)).alias("longitude"),
    )


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Alert messages keyed by parcel."""
    fields = [
        parse.iso_text(F.col(c)).alias(c) if c == "created_at" else F.col(c)
        for c in schemas.ALERT_PAYLOAD.names
    ]
    return _messages(alerts, K.ALERT_TOPIC, F.struct(*fields),
                     derive.micros(F.col("created_at")), F.col("alert_id"))


def decode_alerts(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("topic") == K.ALERT_TOPIC).select(
        F.from_json("value", schemas.ALERT_PAYLOAD).alias("a")
    ).select("a.*").withColumn("created_at", parse.timestamp(F.col("created_at")))


def encode_unknown(dead_letters: DataFrame) -> DataFrame:
    """Error messages of unknown parcels, keyed by parcel; the value is the dead letter itself."""
    return dead_letters.filter(F.col("error_reason") == K.UNKNOWN_PARCEL).select(
        F.lit(K.ERROR_TOPIC).alias("topic"),
        F.get_json_object("raw_message", "$.parcel_id").alias("key"),
        F.col("raw_message").alias("value"),
        derive.micros(F.col("created_at")).alias("at_us"), F.lit("").alias("at_seq"),
    )


def _messages(df: DataFrame, topic: str, payload: Column, at_us: Column,
              at_seq: Column) -> DataFrame:
    return df.select(
        F.lit(topic).alias("topic"), F.col("parcel_id").alias("key"),
        F.to_json(payload, _KEEP_NULLS).alias("value"),
        at_us.alias("at_us"), at_seq.alias("at_seq"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Both topics decoded into one row shape, next to the message's own columns.

    ``problem`` names why a message cannot be used. Plan and event payloads share the parcel and
    hub; fields of the other topic are NULL.
    """
    value, is_plan = F.col("value"), F.col("topic") == K.PLAN_TOPIC
    decoded = messages.withColumns({
        "p": F.when(is_plan, parse.decode(value, schemas.PLANNED_PAYLOAD)),
        "e": F.when(~is_plan, parse.decode(value, schemas.EVENT_PAYLOAD)),
    })
    times = {
        "planned_pickup": F.col("p.planned_pickup"),
        "planned_delivery": F.col("p.planned_delivery"),
        "event_timestamp": F.col("e.event_timestamp"),
    }

    def broken(side: str) -> Column:
        return F.col(f"{side}._corrupt").isNotNull() | F.col(side).isNull()

    numbers = [F.col(f"{side}.{f.name}") for side, schema in (
        ("p", schemas.PLANNED_PAYLOAD), ("e", schemas.EVENT_PAYLOAD))
        for f in schema.fields if f.dataType.typeName() == "double"]
    bad_number = F.lit(False)
    for text in numbers:
        bad_number = bad_number | (text.isNotNull() & parse.number(text).isNull())

    def given(name: str, field: Column, default: Column | str | float) -> Column:
        # The keys are only looked up for absent or null fields.
        return F.when(field.isNotNull() | parse.has_key(value, name), field).otherwise(default)

    parcel = F.when(is_plan, F.col("p.parcel_id")).otherwise(F.col("e.parcel_id"))
    missing = parcel.isNull() | (
        ~is_plan & (F.col("e.event_type").isNull() | F.col("e.event_timestamp").isNull())
    )
    bad_time = F.lit(False)
    for text in times.values():
        bad_time = bad_time | (text.isNotNull() & parse.timestamp(text).isNull())
    return decoded.select(
        *messages.columns,
        F.when(F.when(is_plan, broken("p")).otherwise(broken("e")), "invalid_json")
        .when(missing, "missing_field").when(bad_time, "bad_timestamp")
        .when(bad_number, "bad_number").alias("problem"),
        parcel.alias("parcel_id"),
        F.when(is_plan, F.col("p.hub_id")).otherwise(F.col("e.hub_id")).alias("hub_id"),
        (is_plan | F.col("e.hub_id").isNotNull() | parse.has_key(value, "hub_id")).alias("has_hub"),
        "p.client_id", "p.route_id",
        F.when(is_plan, given(
            "weather_condition", F.col("p.weather_condition"), K.DEFAULT_WEATHER)).alias("weather_condition"),
        F.when(is_plan, given(
            "congestion_level", parse.number(F.col("p.congestion_level")), F.lit(0.0))).alias("congestion_level"),
        *[parse.timestamp(text).alias(name) for name, text in times.items()],
        "e.event_id", "e.event_type",
        parse.is_zoned(F.col("e.event_timestamp")).alias("zoned"),
        *[parse.number(F.col(f"e.{c}")).alias(c) for c in ("latitude", "longitude")],
    )


def with_arrival(decoded: DataFrame) -> DataFrame:
    """Fill in arrival keys the source did not give: plans first, events in replay order."""
    is_plan = F.col("topic") == K.PLAN_TOPIC
    by_payload = F.when(is_plan, F.lit(_BEFORE_EVENTS)).otherwise(
        F.coalesce(derive.micros(F.col("event_timestamp")), F.lit(0)))
    return decoded.withColumns({
        "at_us": F.coalesce("at_us", by_payload),
        "at_seq": F.coalesce("at_seq", "event_id", F.lit("")),
    })


def decode_events(messages: DataFrame) -> DataFrame:
    """Typed events of the event topic."""
    return decode_messages(messages).filter(
        (F.col("topic") == K.EVENT_TOPIC) & F.col("problem").isNull()
    ).select(*schemas.EVENTS.names)
