"""The batch golden record, alerts and dead letters against the message-by-message yardstick."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import simulate
from parceltide import schemas
from parceltide.operators import correlate, golden, upsert

START = datetime(2024, 1, 8, 6)
KINDS = ["accepted", "pickup", "in_transit", "delivered", "scan", "customs"]


def make_messages(seed: int, parcels: int = 25, events: int = 400, hot_share: float = 0.34):
    """Plans first, then events in arrival order; one parcel owns a third of the events."""
    rng = random.Random(seed)
    plans = {}
    for i in range(parcels):
        pickup = START + timedelta(minutes=rng.randrange(3000))
        plans[f"P{i}"] = {
            "parcel_id": f"P{i}", "client_id": f"C{i % 3}", "route_id": f"R{i % 4}",
            "hub_id": f"H{i % 5}", "dest_hub_id": f"H{(i + 1) % 5}",
            "planned_pickup": pickup.isoformat(),
            "planned_delivery": (pickup + timedelta(minutes=rng.randrange(30, 600))).isoformat(),
            "weather_condition": rng.choice(["clear", "rain"]), "congestion_level": rng.random(),
            "distance_km": 10.0, "weight_kg": 1.0,
        }
    messages = [("planned_shipments", p) for p in plans.values()]
    for n in range(events):
        parcel = "P0" if rng.random() < hot_share else f"P{rng.randrange(parcels + 4)}"
        near = plans.get(parcel, plans["P1"])
        base = datetime.fromisoformat(near[rng.choice(["planned_pickup", "planned_delivery"])])
        when = base + timedelta(seconds=rng.randrange(-3600, 4 * 3600))
        messages.append(("delivery_events", {
            "event_id": f"E{n}", "parcel_id": parcel, "event_type": rng.choice(KINDS),
            "event_timestamp": when.isoformat(),
            "hub_id": rng.choice(["H1", "H2", "", None]),
            "latitude": 1.0, "longitude": 2.0,
        }))
    return messages


def frames(spark, messages):
    """Typed plan and event tables; ``seq`` is the arrival order."""
    plans = [(n, *[datetime.fromisoformat(v) if k.startswith("planned_") else v
                   for k, v in p.items()]) for n, (t, p) in enumerate(messages) if t[0] == "p"]
    names = ", ".join(["seq bigint"] + [
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.PLANNED.fields])
    events = [(n, *[datetime.fromisoformat(v) if k == "event_timestamp" else v
                    for k, v in p.items()]) for n, (t, p) in enumerate(messages) if t[0] == "d"]
    event_names = ", ".join(["seq bigint"] + [
        f"{f.name} {f.dataType.simpleString()}" for f in schemas.EVENTS.fields])
    return spark.createDataFrame(plans, names), spark.createDataFrame(events, event_names)


def state_rows(df):
    return {r["parcel_id"]: {k: v for k, v in r.asDict().items() if k != "parcel_id"}
            for r in df.collect()}


def alert_rows(df):
    return sorted(
        map(str, (tuple(r) for r in df.select(
            "parcel_id", "event_type", "severity", "delay_min", "message", "hub_id",
            "client_id", "route_id").collect())))


@pytest.mark.parametrize("seed", [1, 11, 21])
def test_golden_record_matches_sequential_handling(spark, seed):
    messages = make_messages(seed)
    expected, alerts, unknown = simulate.run(messages)
    plan, events = frames(spark, messages)
    folded = golden.fold_plan(plan, ("seq",))
    assert state_rows(golden.golden_record(folded, events, ("seq",))) == expected
    assert alert_rows(correlate.alerts(events, folded)) == sorted(map(str, alerts))
    dead = correlate.dead_letters(events, folded)
    assert dead.count() == len(unknown)
    found = dead.select(F.get_json_object("raw_message", "$.parcel_id"),
                        F.get_json_object("raw_message", "$.event_type")).collect()
    assert sorted(map(tuple, found)) == sorted(unknown)


def test_result_does_not_depend_on_partitioning(spark):
    plan, events = frames(spark, make_messages(2))
    folded = golden.fold_plan(plan, ("seq",))
    results = [
        state_rows(golden.golden_record(folded, events.repartition(n), ("seq",)))
        for n in (1, 7)
    ]
    assert results[0] == results[1]


def test_fold_plan_keeps_first_route_and_last_times(spark):
    rows = spark.sql("""
        select 1 seq, 'A' parcel_id, 'c1' client_id, 'r1' route_id, 'h1' hub_id, 'd1' dest_hub_id,
            timestamp_ntz'2024-01-01 00:00:00' planned_pickup, timestamp_ntz'2024-01-01 01:00:00' planned_delivery,
            'rain' weather_condition, 0.1D congestion_level, 1D distance_km, 2D weight_kg
        union all select 2, 'A', 'c2', 'r2', 'h2', 'd2', timestamp_ntz'2024-01-02 00:00:00',
            timestamp_ntz'2024-01-02 01:00:00', null, 0.9D, 3D, 4D""")
    row = golden.fold_plan(rows, ("seq",)).first()
    assert (row["client_id"], row["hub_id"]) == ("c1", "h1")
    assert row["planned_pickup"] == datetime(2024, 1, 2) and row["weather_condition"] is None


def test_upsert_keeps_history_and_inserts(spark):
    messages = make_messages(3, parcels=6, events=60)
    plan, events = frames(spark, messages)
    state = golden.golden_record(golden.fold_plan(plan, ("seq",)), events, ("seq",))
    resent = []
    for parcel in ("P2", "P3", "NEW"):
        resent.append(("planned_shipments", {
            "parcel_id": parcel, "client_id": "CX", "route_id": "RX", "hub_id": "HX",
            "dest_hub_id": "HY", "planned_pickup": "2025-01-01T00:00:00",
            "planned_delivery": "2025-01-02T00:00:00", "weather_condition": "snow",
            "congestion_level": 0.5, "distance_km": 1.0, "weight_kg": 1.0,
        }))
    expected, _, _ = simulate.run(messages + resent)
    new_plan, _ = frames(spark, resent + messages[-1:])
    merged = upsert.upsert_planned(state, golden.fold_plan(new_plan, ("seq",)))
    assert state_rows(merged) == expected
