"""Explicit schemas; nothing in the package infers one."""

from pyspark.sql import types as T

_STR, _DBL, _NTZ = T.StringType(), T.DoubleType(), T.TimestampNTZType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PLANNED = _struct(
    parcel_id=_STR, client_id=_STR, route_id=_STR, hub_id=_STR, dest_hub_id=_STR,
    planned_pickup=_NTZ, planned_delivery=_NTZ, weather_condition=_STR,
    congestion_level=_DBL, distance_km=_DBL, weight_kg=_DBL,
)

EVENTS = _struct(
    event_id=_STR, parcel_id=_STR, event_type=_STR, event_timestamp=_NTZ,
    hub_id=_STR, latitude=_DBL, longitude=_DBL,
)

EVENT_LOG = T.StructType([*EVENTS.fields, T.StructField("ingested_at", T.TimestampType())])

PARCEL_STATE = _struct(
    parcel_id=_STR, client_id=_STR, route_id=_STR, hub_id=_STR, status=_STR,
    planned_pickup=_NTZ, actual_pickup=_NTZ, planned_delivery=_NTZ, actual_delivery=_NTZ,
    delay_minutes=_DBL, risk_level=_STR, risk_probability=_DBL,
    weather_condition=_STR, congestion_level=_DBL,
)

ALERTS = _struct(
    alert_id=_STR, parcel_id=_STR, alert_type=_STR, severity=_STR, delay_min=_DBL, event_type=_STR,
    hub_id=_STR, client_id=_STR, route_id=_STR, message=_STR, created_at=_NTZ,
    acknowledged=T.BooleanType(),
)
DEAD_LETTERS = _struct(topic=_STR, raw_message=_STR, error_reason=_STR, created_at=_NTZ)

# Payloads as they travel on the topics: timestamps are ISO text.
PLANNED_PAYLOAD = _struct(
    parcel_id=_STR, client_id=_STR, route_id=_STR, hub_id=_STR, dest_hub_id=_STR,
    planned_pickup=_STR, planned_delivery=_STR, weather_condition=_STR,
    congestion_level=_DBL, distance_km=_DBL, weight_kg=_DBL,
)

EVENT_PAYLOAD = _struct(
    event_id=_STR, parcel_id=_STR, event_type=_STR, event_timestamp=_STR,
    hub_id=_STR, latitude=_DBL, longitude=_DBL, replayed_at=_STR,
)

ALERT_PAYLOAD = _struct(
    alert_id=_STR, parcel_id=_STR, alert_type=_STR, severity=_STR, delay_min=_DBL,
    event_type=_STR, hub_id=_STR, client_id=_STR, route_id=_STR, message=_STR, created_at=_STR,
)

HUBS = _struct(
    hub_id=_STR, hub_name=_STR, city=_STR, latitude=_DBL, longitude=_DBL,
    capacity=T.IntegerType(),
)
ROUTES = _struct(
    route_id=_STR, origin=_STR, destination=_STR, distance_km=_DBL, avg_duration_h=_DBL,
)
CLIENTS = _struct(
    client_id=_STR, client_name=_STR, sla_hours=_DBL, priority=T.IntegerType(),
)

# A message of either topic before decoding. ``(at_us, at_seq)`` is its arrival order, as the
# record timestamp and offset are in Kafka.
TOPIC_MESSAGE = _struct(topic=_STR, key=_STR, value=_STR, at_us=T.LongType(), at_seq=_STR)
