"""Delay, risk, severity, status and alert expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parceltide import constants as K

_MICROS_PER_MINUTE = 60_000_000.0
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def micros(ts: Column) -> Column:
    """Microseconds from the epoch to a zone-less timestamp, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), ts)


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end).cast("double") / F.lit(_MICROS_PER_MINUTE)


def case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    """``CASE WHEN … THEN … ELSE … END`` over (condition, value) pairs."""
    condition, value = branches[0]
    chain = F.when(condition, value)
    for condition, value in branches[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def event_delay(
    event_type: Column,
    event_ts: Column,
    planned_pickup: Column,
    planned_delivery: Column,
    zoned: Column | None = None,
) -> Column:
    """Minutes late of one event: pickups against the planned pickup, deliveries against the
    planned delivery, 0 for anything else and whenever the plan has no time to compare with.

    ``zoned`` marks event times that carried a numeric UTC offset; they cannot be compared
    with zone-less plan times and count as no delay.
    """
    late = F.when(event_type == "pickup", minutes_between(planned_pickup, event_ts)).when(
        event_type == "delivered", minutes_between(planned_delivery, event_ts)
    )
    if zoned is not None:
        late = F.when(~F.coalesce(zoned, F.lit(False)), late)
    return F.coalesce(late, F.lit(0.0))


def risk_level(delay: Column) -> Column:
    return (
        F.when(delay > K.MEDIUM_MAX_MIN, "high")
        .when(delay > K.LOW_MAX_MIN, "medium")
        .otherwise("low")
    )


def risk_probability(delay: Column) -> Column:
    one = F.lit(1.0)
    return (
        F.when(delay > K.MEDIUM_MAX_MIN, F.least(one, 0.7 + (delay - K.MEDIUM_MAX_MIN) / 150))
        .when(delay > K.LOW_MAX_MIN, F.least(one, 0.3 + (delay - K.LOW_MAX_MIN) / 90))
        .when(delay > 0, F.least(F.lit(0.3), delay / 50))
        .otherwise(0.0)
    )


def risk_label(delay: Column) -> Column:
    """Training label of a delay: 0 low, 1 medium, 2 high."""
    return F.when(delay > K.MEDIUM_MAX_MIN, 2).when(delay > K.LOW_MAX_MIN, 1).otherwise(0)


def severity(delay: Column) -> Column:
    return case([(delay > limit, F.lit(name)) for name, limit in K.SEVERITY_LIMITS],
                F.lit(K.SEVERITY_FLOOR))


def status_of_event(event_type: Column) -> Column:
    """Status an event leads to; NULL for types that keep the previous status."""
    return case([(event_type == event, F.lit(status)) for event, status in
                 K.STATUS_BY_EVENT.items()], F.lit(None).cast("string"))


def alert_message(parcel_id: Column, delay: Column, event_type: Column) -> Column:
    whole = F.rint(delay).cast("bigint").cast("string")
    return F.concat(F.lit("Colis "), parcel_id, F.lit(" en retard de "), whole,
                    F.lit(" min ("), event_type, F.lit(")"))


def event_id(parcel_id: Column, event_type: Column, event_ts: Column) -> Column:
    """``EV-<parcel>-<TYP>-<epoch ms>``, from the event's own time so that it is repeatable."""
    return F.concat(
        F.lit("EV-"), parcel_id, F.lit("-"), F.upper(F.substring(event_type, 1, 3)),
        F.lit("-"), F.floor(micros(event_ts) / 1000).cast("string"),
    )


def alert_id(parcel_id: Column, event_ts: Column) -> Column:
    """``ALT-<parcel>-<epoch s>``."""
    return F.concat(F.lit("ALT-"), parcel_id, F.lit("-"),
                    F.floor(micros(event_ts) / 1_000_000).cast("string"))


def hub_colour(high_risk: Column, medium_risk: Column) -> Column:
    """Marker colour; hubs without parcels (NULL counts) are green."""
    return (
        F.when(high_risk > K.HUB_RED_ABOVE_HIGH, "red")
        .when(medium_risk > K.HUB_ORANGE_ABOVE_MEDIUM, "orange")
        .otherwise("green")
    )


def display_severity(level: Column) -> Column:
    return F.when(level.isin(*K.KNOWN_SEVERITIES), level).otherwise(K.SEVERITY_FLOOR)


def severity_icon(level: Column) -> Column:
    return (
        F.when(level.isin("critical", "high"), "🔴").when(level == "medium", "🟠").otherwise("🟢")
    )


def lookup(key: Column, table: dict[str, float], default: float) -> Column:
    """Value of a small fixed table, as a ``CASE`` that stays inside codegen."""
    return case([(key == name, F.lit(float(number))) for name, number in table.items()],
                F.lit(float(default)))
