"""The expected results of small message lists, stated as picks over each parcel's sorted messages."""

from __future__ import annotations

from collections import defaultdict
from datetime import datetime

# --- fixed values: status of an event type; (above, level, least, from, span, most) of the risk; severities ---
STATUS = {"accepted": "accepted", "pickup": "picked_up", "in_transit": "in_transit",
          "delivered": "delivered"}
RISK_BANDS = ((60, "high", 0.7, 60, 150, 1.0), (15, "medium", 0.3, 15, 90, 1.0), (0, "low", 0.0, 0, 50, 0.3))
SEVERITIES = ((120, "critical"), (60, "high"), (30, "medium"), (float("-inf"), "low"))
_PLANNED_TIME = {"pickup": "planned_pickup", "delivered": "planned_delivery"}


def parsed(text: str) -> datetime:
    return datetime.fromisoformat(text.replace("Z", ""))


def wall_time(text: str) -> datetime:
    return parsed(text).replace(tzinfo=None)


def risk(delay: float) -> tuple[str, float]:
    band = next((b for b in RISK_BANDS if delay > b[0]), None)
    if band is None:
        return "low", 0.0
    _, level, least, start, span, most = band
    return level, min(most, least + (delay - start) / span)


def severity(delay: float) -> str:
    return next(name for limit, name in SEVERITIES if delay > limit)


def delay_of(event: dict, plan: dict) -> float | None:
    """Minutes after the planned time; none without one, and none for a time with a zone."""
    planned = plan.get(_PLANNED_TIME.get(event["event_type"]))
    seen = parsed(event["event_timestamp"])
    if not planned or seen.tzinfo is not None:
        return None
    return (seen - datetime.fromisoformat(planned)).total_seconds() / 60


def _newest(events: list[tuple[int, dict, dict]], wanted) -> tuple[int, dict, dict] | None:
    return max((e for e in events if wanted(e[1])), key=lambda e: e[0], default=None)


def _record(plans: list[tuple[int, dict]], known: list[tuple[int, dict, dict]]) -> dict:
    """The state of a parcel with ``plans`` (position, plan) and ``known`` (position, event, plan in force)."""
    first, (planned_at, plan) = plans[0][1], plans[-1]
    last = _newest(known, lambda e: True)
    mapped = _newest(known, lambda e: e["event_type"] in STATUS)
    hub = _newest(known, lambda e: "hub_id" in e)
    delay = (last and delay_of(last[1], last[2])) or 0.0
    level, probability = risk(delay)
    record = {
        "client_id": first.get("client_id"), "route_id": first.get("route_id"),
        "hub_id": (hub[1] if hub else first).get("hub_id"),
        "status": STATUS[mapped[1]["event_type"]] if mapped and mapped[0] > planned_at else "planned",
        "delay_minutes": delay, "risk_level": level, "risk_probability": probability,
        "weather_condition": plan.get("weather_condition", "clear"),
        "congestion_level": plan.get("congestion_level", 0.0),
    }
    for kind, column in _PLANNED_TIME.items():
        record[column] = datetime.fromisoformat(plan[column]) if plan.get(column) else None
        found = _newest(known, lambda e, kind=kind: e["event_type"] == kind)
        record[column.replace("planned", "actual")] = (
            wall_time(found[1]["event_timestamp"]) if found else None)
    return record


def run(messages: list[tuple[str, dict]], threshold: float = 15.0):
    """Final state by parcel, alerts and unknown events of ``(topic, payload)`` in arrival order."""
    plans, events = defaultdict(list), []
    for at, (topic, payload) in enumerate(messages):
        if topic == "planned_shipments":
            plans[payload["parcel_id"]].append((at, payload))
        else:
            earlier = plans.get(payload["parcel_id"])
            events.append((at, payload, earlier[-1][1] if earlier else None))

    unknown = [(e["parcel_id"], e["event_type"]) for _, e, plan in events if plan is None]
    known = defaultdict(list)
    for event in events:
        if event[2] is not None:
            known[event[1]["parcel_id"]].append(event)
    state = {parcel: _record(versions, known[parcel]) for parcel, versions in plans.items()}

    late = [(e, plans[e["parcel_id"]][0][1], delay) for _, e, plan in events if plan is not None
            and (delay := delay_of(e, plan)) is not None and delay > threshold]
    alerts = [(e["parcel_id"], e["event_type"], severity(delay),
               round(delay, 1), f"Colis {e['parcel_id']} en retard de {delay:.0f} min ({e['event_type']})",
               e.get("hub_id"), first.get("client_id"), first.get("route_id"))
              for e, first, delay in late]
    return state, alerts, unknown
