"""Event-to-plan correlation and what follows from it: alerts, dead letters, the event log.

``plan`` always has one row per parcel. Both join inputs are plain scans, so when one parcel
owns a large share of the events the adaptive skew join splits its shuffle partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import constants as K
from parceltide.functions import derive, parse
from parceltide.functions.aggregates import round_double

_KEEP_NULLS = {"ignoreNullFields": "false"}
_PLAN_SIDE = ("parcel_id", "client_id", "route_id", "planned_pickup", "planned_delivery")


def correlate_events(events: DataFrame, plan: DataFrame) -> DataFrame:
    """Every event with its plan; ``known`` is false for parcels nobody planned."""
    side = plan.select(*_PLAN_SIDE, F.lit(True).alias("known"))
    return with_delay(
        events.join(side, "parcel_id", "left").withColumn(
            "known", F.coalesce(F.col("known"), F.lit(False))
        )
    )


def with_delay(correlated: DataFrame) -> DataFrame:
    zoned = F.col("zoned") if "zoned" in correlated.columns else None
    return correlated.withColumn(
        "delay_minutes",
        derive.event_delay(
            F.col("event_type"), F.col("event_timestamp"),
            F.col("planned_pickup"), F.col("planned_delivery"), zoned,
        ),
    )


def exceptional(events: DataFrame, plan: DataFrame, threshold: float = K.ALERT_THRESHOLD_MIN) -> DataFrame:
    """Correlated events that are late or that no plan knows: what ``alerts_of`` and ``dead_letters_of`` start from."""
    return correlate_events(events, plan).filter(~F.col("known") | (F.col("delay_minutes") > threshold))


def alerts(
    events: DataFrame, plan: DataFrame, threshold: float = K.ALERT_THRESHOLD_MIN
) -> DataFrame:
    """Late pickups and deliveries of planned parcels. Other event types can never alert, so
    they are dropped before the join."""
    candidates = events.filter(F.col("event_type").isin("pickup", "delivered"))
    return alerts_of(with_delay(candidates.join(plan.select(*_PLAN_SIDE), "parcel_id")), threshold)


def alerts_of(correlated: DataFrame, threshold: float = K.ALERT_THRESHOLD_MIN) -> DataFrame:
    """Alert rows of events that already carry their plan and delay."""
    delay = F.col("delay_minutes")
    return correlated.filter(delay > threshold).select(
        derive.alert_id(F.col("parcel_id"), F.col("event_timestamp")).alias("alert_id"),
        "parcel_id",
        F.lit(K.ALERT_TYPE).alias("alert_type"),
        derive.severity(delay).alias("severity"),
        round_double(delay, 1).alias("delay_min"),
        "event_type", "hub_id", "client_id", "route_id",
        derive.alert_message(F.col("parcel_id"), delay, F.col("event_type")).alias("message"),
        F.col("event_timestamp").alias("created_at"),
        F.lit(False).alias("acknowledged"),
    )


def unknown_events(events: DataFrame, plan: DataFrame) -> DataFrame:
    return events.join(plan.select("parcel_id"), "parcel_id", "left_anti")


def wire_event(columns: list[str]) -> Column:
    """The event as it travels on the topic: times as ISO text."""
    fields = []
    for name in ("event_id", "parcel_id", "event_type", "event_timestamp",
                 "hub_id", "latitude", "longitude"):
        if name == "event_timestamp":
            fields.append(parse.iso_text(F.col(name)).alias(name))
        elif name in columns:
            fields.append(F.col(name))
    return F.struct(*fields)


def dead_letters(events: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows for the error topic and table: events of parcels without a plan."""
    return dead_letters_of(unknown_events(events, plan))


def dead_letters_of(unknown: DataFrame, reason: str = K.UNKNOWN_PARCEL) -> DataFrame:
    message = F.struct(
        F.lit(reason).alias("reason"), F.col("parcel_id"), F.col("event_type"),
        wire_event(unknown.columns).alias("raw"),
    )
    return unknown.select(
        F.lit(K.EVENT_TOPIC).alias("topic"),
        F.to_json(message, _KEEP_NULLS).alias("raw_message"),
        F.lit(reason).alias("error_reason"),
        F.col("event_timestamp").alias("created_at"),
    )


def events_log(events: DataFrame) -> DataFrame:
    """Event history rows with the raw message. Every event is logged, planned or not."""
    return events.select(
        "parcel_id", "event_type", "event_timestamp", "hub_id", "latitude", "longitude",
        F.to_json(wire_event(events.columns), _KEEP_NULLS).alias("raw_payload"),
    )


def message_counts(events: DataFrame, plan: DataFrame,
                   threshold: float = K.ALERT_THRESHOLD_MIN) -> DataFrame:
    """Counters of one run: plan rows, events, alerts, errors."""
    late = F.col("known") & (F.col("delay_minutes") > threshold)
    names = ("planned", "events", "alerts", "errors")
    handled = correlate_events(events, plan).agg(
        F.lit(0).cast("bigint").alias("planned"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(late).alias("alerts"),
        F.count_if(~F.col("known")).alias("errors"),
    )
    planned = plan.agg(
        F.count(F.lit(1)).alias("planned"),
        *[F.lit(0).cast("bigint").alias(c) for c in names[1:]],
    )
    return handled.unionByName(planned).agg(*[F.sum(c).alias(c) for c in names])


def event_span(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_event"),
        F.max("event_timestamp").alias("last_event"),
    )


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id. ``min`` over the whole row combines map-side and, unlike picking
    any row, does not depend on the order of arrival."""
    rest = [c for c in events.columns if c != "event_id"]
    return events.groupBy("event_id").agg(F.min(F.struct(*rest)).alias("row")).select(
        "event_id", "row.*"
    )
