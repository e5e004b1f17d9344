"""The golden record: one row per parcel, folded from its plan rows and its events.

The fold is a set of ``max``/``min`` aggregates over ``struct(arrival key, payload)``. Those
combine map-side, so a parcel that owns a third of all events still sends one row per input
partition through the shuffle, and no task ever holds a parcel's history. Because the arrival
key is part of the compared struct, ties cannot make the result depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import constants as K, schemas
from parceltide.functions import derive

# Chronological replay order; the id separates events of the same instant.
EVENT_ORDER = ("event_timestamp", "event_id")

_PLAN_FIRST = ("client_id", "route_id", "hub_id", "dest_hub_id", "distance_km", "weight_kg")
_PLAN_LAST = ("planned_pickup", "planned_delivery", "weather_condition", "congestion_level")


def keyed(order: Sequence[str], *payload: str) -> Column:
    """``struct(arrival key, payload)``, flat and without repeating a key column: the buffers of
    the fold are compared and copied for every row."""
    return F.struct(*order, *[c for c in payload if c not in order])


def fold_plan(planned: DataFrame, order: Sequence[str]) -> DataFrame:
    """One plan row per parcel after upserting its rows in arrival order: the first row fixes
    client, route and hub, the last one the planned times, weather and congestion."""
    first = [c for c in _PLAN_FIRST if c in planned.columns]
    last = [c for c in _PLAN_LAST if c in planned.columns]
    folded = planned.groupBy("parcel_id").agg(
        F.min(keyed(order, *first)).alias("first"),
        F.max(keyed(order, *last)).alias("last"),
    )
    kept = [c for c in schemas.PLANNED.names if c in first + last]
    return folded.select(
        "parcel_id", *[F.col(f"{'first' if c in first else 'last'}.{c}") for c in kept]
    )


def event_facts(events: DataFrame, order: Sequence[str] = EVENT_ORDER) -> list[Column]:
    """The aggregates that carry everything later steps need from a parcel's events."""
    kind = F.col("event_type")
    zoned = F.col("zoned") if "zoned" in events.columns else F.lit(False).alias("zoned")
    # The stream compares the arrival of the last mapped event with that of the plan.
    arrived = [c for c in ("arrived_us", "arrived_seq") if c in events.columns]
    reference = [c for c in ("planned_pickup", "planned_delivery") if c in events.columns]
    payload = ("event_type", "event_timestamp", "hub_id", *reference)
    last = F.max(F.struct(*order, *[c for c in payload if c not in order], zoned))
    if "has_hub" in events.columns:
        hub = F.max(F.when(F.col("has_hub"), keyed(order, "hub_id")))
    else:
        hub = F.struct(last["hub_id"].alias("hub_id"))

    def latest(event: str) -> Column:
        if order[0] == "event_timestamp":
            when = F.when(kind == event, F.col("event_timestamp"))
            return F.struct(F.max(when).alias("event_timestamp"))
        return F.max(F.when(kind == event, keyed(order, "event_timestamp")))

    return [
        last.alias("last"),
        hub.alias("hub"),
        F.max(F.when(kind.isin(*K.STATUS_BY_EVENT), keyed(order, "event_type", *arrived))).alias("mapped"),
        latest("pickup").alias("picked"),
        latest("delivered").alias("dropped"),
    ]


def fold_events(events: DataFrame, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    return events.groupBy("parcel_id").agg(*event_facts(events, order))


def state_columns(
    reference_pickup: Column, reference_delivery: Column, replanned: Column | None = None
) -> list[Column]:
    """Golden-record columns from a plan row and the event facts next to it (NULL = no event).

    ``replanned`` is true where the plan was sent again after the last mapped event, which puts
    the status back to ``planned`` and touches nothing else.
    """
    delay = derive.event_delay(
        F.col("last.event_type"), F.col("last.event_timestamp"),
        reference_pickup, reference_delivery, F.col("last.zoned"),
    )
    status = derive.status_of_event(F.col("mapped.event_type"))
    if replanned is not None:
        status = F.when(~F.coalesce(replanned, F.lit(False)), status)
    return [
        F.col("parcel_id"), F.col("client_id"), F.col("route_id"),
        # An event's hub replaces the planned one even when it is NULL.
        F.when(F.col("hub").isNotNull(), F.col("hub.hub_id"))
        .otherwise(F.col("hub_id")).alias("hub_id"),
        F.coalesce(status, F.lit(K.INITIAL_STATUS)).alias("status"),
        F.col("planned_pickup"),
        F.col("picked.event_timestamp").alias("actual_pickup"),
        F.col("planned_delivery"),
        F.col("dropped.event_timestamp").alias("actual_delivery"),
        delay.alias("delay_minutes"),
        derive.risk_level(delay).alias("risk_level"),
        derive.risk_probability(delay).alias("risk_probability"),
        F.col("weather_condition"), F.col("congestion_level"),
    ]


def golden_record(
    plan: DataFrame, events: DataFrame, order: Sequence[str] = EVENT_ORDER
) -> DataFrame:
    """Batch golden record. ``plan`` has one row per parcel and was known before the events
    (see ``fold_plan``). Events are folded before the join, so it is one row to one row."""
    joined = plan.join(fold_events(events, order), "parcel_id", "left")
    return joined.select(*state_columns(F.col("planned_pickup"), F.col("planned_delivery")))
