"""The control-tower stream against the yardstick: interleaving, re-plans, bad messages, restart."""

import glob
import json
import random
import re
import shutil
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import simulate
from parceltide import schemas
from parceltide.sources import topics
from parceltide.streaming import timeline, tower
from parceltide.operators import golden, store_queries
from test_golden import alert_rows, frames, make_messages, state_rows


def interleaved(seed: int):
    """Plans arrive between the events, some twice, some too late; some hubs are left out."""
    rng = random.Random(seed)
    messages = make_messages(seed, parcels=12, events=150)
    plans, events = messages[:12], messages[12:]
    mixed = plans[:8] + events
    for topic, plan in plans[8:]:
        mixed.insert(rng.randrange(20, len(mixed)), (topic, plan))
    for topic, plan in plans[:5]:
        again = {**plan, "planned_pickup": "2024-01-09T00:00:00", "client_id": "OTHER",
                 "planned_delivery": "2024-01-09T05:00:00", "weather_condition": "snow"}
        mixed.insert(rng.randrange(20, len(mixed)), (topic, again))
    for n, (topic, payload) in enumerate(mixed):
        if topic == "delivery_events":
            if n % 7 == 0:
                payload = {k: v for k, v in payload.items() if k != "hub_id"}
            if n % 11 == 0:
                payload = {**payload, "event_timestamp": payload["event_timestamp"] + "+02:00"}
            elif n % 13 == 0:
                payload = {**payload, "event_timestamp": payload["event_timestamp"] + "Z"}
            mixed[n] = (topic, payload)
    return mixed


BAD = [
    ("delivery_events", '{"parcel_id": "P1", broken', "invalid_json"),
    ("delivery_events", '{"parcel_id": "P1", "event_type": "pickup"}', "missing_field"),
    ("delivery_events", '{"parcel_id": "P1", "event_type": "pickup", "event_timestamp": "soon"}',
     "bad_timestamp"),
    ("planned_shipments", '{"client_id": "C1"}', "missing_field"),
    ("planned_shipments", '{"parcel_id": "P1", "planned_pickup": "later"}', "bad_timestamp"),
]


def publish(spark, rows, path):
    """One file with ``(arrival, topic, json)`` rows."""
    frame = spark.createDataFrame(
        [(t, None, v, n, "") for n, t, v in rows], schemas.TOPIC_MESSAGE).coalesce(1)
    topics.publish_files(frame, path)


def encoded(messages):
    return [(n, t, json.dumps(p)) for n, (t, p) in enumerate(messages)]


def run_tower(spark, source, out, **options):
    stream = topics.stream_file_topic(spark, source, 1)
    tower.start_tower(stream, out, **{"buckets": 4, **options}).awaitTermination()
    return tower.TowerTables(spark, out)


def check(tables, messages, bad=0):
    expected, alerts, unknown = simulate.run(messages)
    assert state_rows(tables.state) == expected
    assert alert_rows(tables.alerts) == sorted(map(str, alerts))
    reasons = Counter(r[0] for r in tables.errors.select("error_reason").collect())
    assert reasons["unknown_parcel"] == len(unknown)
    assert sum(reasons.values()) == len(unknown) + bad
    events = sum(1 for t, _ in messages if t == "delivery_events")
    assert tables.log.count() == events


def test_interleaved_topics_over_several_batches_and_a_restart(spark, folder):
    messages = interleaved(5)
    rows = encoded(messages)
    source, out = f"{folder}/in", f"{folder}/out"
    cuts = [0, 40, 110, len(rows)]
    for a, b in list(zip(cuts, cuts[1:]))[:2]:
        publish(spark, rows[a:b], source)
    tables = run_tower(spark, source, out, refresh_kpi=True)
    check(tables, messages[: cuts[2]])

    tower.compact(tables, through=0)
    check(tables, messages[: cuts[2]])

    # The stream stops and starts again from its checkpoint; bad messages arrive as well.
    bad = [(10_000 + n, topic, value) for n, (topic, value, _) in enumerate(BAD)]
    publish(spark, rows[cuts[2]:] + bad, source)
    with pytest.raises(ValueError, match="order_by"):
        tower.start_tower(topics.stream_file_topic(spark, source, 1), out, order_by="other")
    tables = run_tower(spark, source, out, refresh_kpi=True)
    check(tables, messages, bad=len(BAD))
    reasons = Counter(r[0] for r in tables.errors.select("error_reason").collect())
    assert all(reasons[reason] >= 1 for _, _, reason in BAD)

    tower.compact(tables, through=2)
    tower.compact(tables, through=1)
    check(tables, messages, bad=len(BAD))
    last = tables.kpis.orderBy(F.col("batch_id").desc()).first()
    assert last["total_parcels"] == tables.state.count()


@pytest.fixture(autouse=True)
def whole_filters(spark):
    """Plans state their filters in full."""
    name = "spark.sql.maxMetadataStringLength"
    spark.conf.set(name, "10000")
    yield
    spark.conf.unset(name)


def partition_filters(df):
    return re.findall(r"PartitionFilters: \[(.*?)\]", df._jdf.queryExecution().executedPlan().toString())


def test_a_batch_reads_the_buckets_of_its_parcels_only(spark, folder):
    messages = [(t, {**p, "parcel_id": f"Q{n}"}) for n, (t, p) in enumerate(make_messages(3, parcels=40, events=0))]
    publish(spark, encoded(messages), f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", buckets=16)
    assert tables.layout(99, "year") == (16, "day")  # fixed by the first batch
    one = topics.decode_messages(topics.read_file_topic(spark, f"{folder}/in")).filter("parcel_id = 'Q7'")
    bucket = one.select(tower.bucket_of("parcel_id", 16)).first()[0]
    for with_events in (False, True):
        held = tower.facts_before(tables, one, 1, with_events)
        assert held.collect()[0]["parcel_id"] == "Q7"
        assert f"(bucket#" in partition_filters(held)[0] and f"= {bucket})" in partition_filters(held)[0]
    everything = spark.read.parquet(f"{folder}/out/facts").count()
    bucket_rows = tables.facts(0).filter(F.col("bucket") == bucket).count()
    assert everything == 40 and bucket_rows < 10


def test_kpi_of_late_batches_reads_no_more_than_that_of_early_ones(spark, folder):
    """Every batch touches two parcels of its own; the KPI row follows from the row before it."""
    messages = make_messages(4, parcels=24, events=0)
    for n in range(12):
        publish(spark, [(2 * n + k, t, json.dumps({**p, "parcel_id": f"K{2 * n + k}"}))
                        for k, (t, p) in enumerate(messages[2 * n:2 * n + 2])], f"{folder}/in")
    late = {"event_id": "E", "parcel_id": "K0", "event_type": "delivered", "event_timestamp": "2030-01-01T00:00:00"}
    publish(spark, [(99, "delivery_events", json.dumps(late))], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", refresh_kpi=True, compact_every=100, buckets=64)
    kpis = {r["batch_id"]: r for r in tables.kpis.collect()}
    assert [kpis[n]["total_parcels"] for n in range(13)] == [*range(2, 25, 2), 24]
    assert kpis[11]["delivered"] == 0 and kpis[12]["delivered"] == kpis[12]["high_risk"] == 1
    want = store_queries.kpi_summary(tables.state).first()
    assert {c: kpis[12][c] for c in want.asDict()} == want.asDict()
    read = {}
    for batch in (2, 11):
        incoming = spark.read.parquet(f"{folder}/out/incoming/batch_id={batch}")
        buckets = tower.touched_buckets(incoming, "parcel_id", 64)
        read[batch] = tables.facts(batch - 1).filter(F.col("bucket").isin(buckets)).count()
        before = spark.read.parquet(f"{folder}/out/before/batch_id={batch}")
        plan = tower.kpi_sums(tables, before, batch)._jdf.queryExecution().toString()
        assert "facts/batch_id=" in plan and "generation" not in plan
    assert max(read.values()) <= 3  # of up to 22 parcels


def test_kpi_turned_on_later_counts_everything(spark, folder):
    messages = interleaved(6)
    rows = encoded(messages)
    publish(spark, rows[:80], f"{folder}/in")
    run_tower(spark, f"{folder}/in", f"{folder}/out", buckets=4)
    publish(spark, rows[80:120], f"{folder}/in")
    publish(spark, rows[120:], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", refresh_kpi=True)
    want = store_queries.kpi_summary(tables.state).first().asDict()
    got = tables.kpis.filter(F.col("batch_id") == 2).first().asDict()
    assert {c: got[c] for c in want} == want


def test_repeated_events_are_dropped_and_forgotten_behind_the_horizon(spark, folder):
    def event(n, hours):
        return {"event_id": f"E{n}", "parcel_id": "P1", "event_type": "in_transit", "hub_id": "H",
                "event_timestamp": (datetime(2024, 1, 1) + timedelta(hours=hours)).isoformat()}

    plan = {"parcel_id": "P1", "planned_pickup": "2024-01-01T08:00:00", "planned_delivery": "2024-01-01T12:00:00"}
    no_id = {k: v for k, v in event(0, 1).items() if k != "event_id"}
    batches = [
        [("planned_shipments", plan), *[("delivery_events", event(n % 3, n % 3)) for n in range(9)]],
        [("delivery_events", event(1, 1)), ("delivery_events", event(3, 30)), ("delivery_events", no_id),
         ("delivery_events", no_id)],
        [("delivery_events", event(1, 1)), ("delivery_events", event(3, 30)), ("delivery_events", event(4, 31))],
    ]
    n = 0
    for batch in batches:
        publish(spark, [(n := n + 1, t, json.dumps(p)) for t, p in batch], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", dedup_days=1.0, buckets=4, compact_every=3)
    got = sorted((r["batch_id"], r["event_id"] or "") for r in tables.log.select("batch_id", "event_id").collect())
    # E1 of the last batch is a day older than E3, so it is not remembered any more.
    assert got == [(0, "E0"), (0, "E1"), (0, "E2"), (1, ""), (1, ""), (1, "E3"), (2, "E1"), (2, "E4")]
    assert [r["repeated"] for r in tables.counts.orderBy("batch_id").collect()] == [6, 1, 1]
    assert not tables.has("seen/batch_id=0") and tables.has("seen/batch_id=1")
    assert not tables.has("every/batch_id=0")


def test_log_of_some_days_opens_their_folders_only(spark, folder):
    messages = interleaved(5)
    rows = encoded(messages)
    publish(spark, rows[:80], f"{folder}/in")
    publish(spark, rows[80:], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", buckets=4)
    days = Counter(r[0] for r in tables.log.select("event_day").collect())
    manifest = tables.manifest.filter("name = 'delivery_events_log'")
    assert {r["period"]: r["n"] for r in manifest.groupBy("period").agg(F.sum("rows").alias("n")).collect()} == days
    first, last = min(days), max(days)
    one = tables.log_of(first, first)
    assert one.count() == days[first] and all(f"event_day={first}" in f for f in one.inputFiles())
    assert store_queries.event_timeline(tables.log_of(first, last)).agg(F.sum("count")).first()[0] == sum(days.values())
    assert tables.log_of(last + timedelta(days=9), last + timedelta(days=99)).count() == 0
    by_day = store_queries.event_timeline(tables.log.filter(F.col("event_day") == F.lit(first)))
    assert "event_day" in partition_filters(by_day)[0]
    assert tables.periods("alerts").newest_first == sorted(
        {r[0] for r in tables.alerts.select("created_day").distinct().collect()}, reverse=True)


def test_one_file_gives_the_same_result(spark, folder):
    messages = interleaved(5)
    publish(spark, encoded(messages), f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out",
                       publish=lambda m: topics.publish_files(m, f"{folder}/published"))
    check(tables, messages)
    published = topics.read_file_topic(spark, f"{folder}/published")
    counts = {r["topic"]: r["count"] for r in published.groupBy("topic").count().collect()}
    _, alerts, unknown = simulate.run(messages)
    assert counts == {"alerts": len(alerts), "error_logs": len(unknown)}
    assert alert_rows(topics.decode_alerts(published)) == sorted(map(str, alerts))
    keys = published.filter("topic = 'error_logs'").select("key").collect()
    assert sorted(r[0] for r in keys) == sorted(parcel for parcel, _ in unknown)


def test_late_events_are_ignored_in_event_time_order(spark, folder):
    messages = make_messages(8, parcels=10, events=120)
    rows = encoded(messages)
    publish(spark, rows[:70], f"{folder}/in")
    publish(spark, rows[70:], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", order_by=tower.EVENT_TIME)
    plan, events = frames(spark, messages)
    expected = golden.golden_record(golden.fold_plan(plan, ("seq",)), events)
    assert state_rows(tables.state) == state_rows(expected)
    _, alerts, _ = simulate.run(messages)
    assert alert_rows(tables.alerts) == sorted(map(str, alerts))


def test_an_unpublished_batch_is_not_read_and_repeating_it_changes_nothing(spark, folder):
    messages = interleaved(6)[:60]
    publish(spark, encoded(messages), f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out")
    source = topics.read_file_topic(spark, f"{folder}/in")
    tower.write_batch(tables, source, 0)  # published already
    check(tables, messages)
    shutil.move(f"{folder}/out/published/batch_id=0", f"{folder}/marker")
    assert tables.state.count() == tables.log.count() == 0
    tower.write_batch(tables, source, 0)
    check(tables, messages)


def test_half_a_compaction_loses_no_parcel(spark, folder):
    messages = interleaved(9)
    rows = encoded(messages)
    for n in range(0, len(rows), 12):
        publish(spark, rows[n:n + 12], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", compact_every=4)
    check(tables, messages)
    batches = tables.published()
    assert len(tables.generations()) == 2 and batches >= 12
    for step in ("incoming", "before", "merged", "handled"):
        assert not tables.has(f"{step}/batch_id=0")
    counts = tables.counts.agg(F.sum("plans"), F.sum("events")).first()
    assert sum(counts) == len(messages)
    # The newest generation was written, but its job died before the marker and left half of it.
    number, facts = tables.generations()[-1]
    shutil.move(f"{folder}/out/generations/number={number}", f"{folder}/marker")
    part = next(glob.iglob(f"{folder}/out/{facts}/**/part-*.parquet", recursive=True))
    shutil.move(part, f"{folder}/part")
    check(tables, messages)
    tower.compact(tables, batches)
    check(tables, messages)


def test_the_stream_reads_its_source_once_and_needs_no_python(spark, folder):
    messages = interleaved(5)
    publish(spark, encoded(messages), f"{folder}/in")
    stream = topics.stream_file_topic(spark, f"{folder}/in", 1)
    query = tower.start_tower(stream, f"{folder}/out")
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == len(messages)
    tables = tower.TowerTables(spark, f"{folder}/out")
    incoming = spark.read.parquet(f"{folder}/out/incoming/batch_id=0")
    merged = spark.read.parquet(f"{folder}/out/merged/batch_id=0")
    for df in (tower.facts_before(tables, incoming, 1, True), tower.plan_in_force(merged)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan


def test_plans_that_arrive_after_the_event_times_do_not_reset_the_status(spark, folder):
    plan = {"parcel_id": "P1", "client_id": "C", "route_id": "R", "hub_id": "H",
            "planned_pickup": "2024-01-01T08:00:00", "planned_delivery": "2024-01-01T12:00:00"}
    event = {"event_id": "E1", "parcel_id": "P1", "event_type": "delivered",
             "event_timestamp": "2024-01-01T12:30:00", "hub_id": "H"}
    replayed = 1_767_225_600_000_000  # 2026
    for at, topic, payload in ((0, "planned_shipments", plan), (1, "delivery_events", event)):
        publish(spark, [(replayed + at, topic, json.dumps(payload))], f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", order_by=tower.EVENT_TIME)
    assert tables.state.first()["status"] == "delivered"
    publish(spark, [(replayed + 2, "planned_shipments", json.dumps(plan))], f"{folder}/in")
    assert run_tower(spark, f"{folder}/in", f"{folder}/out", order_by=tower.EVENT_TIME).state.first()[
        "status"] == "planned"


def test_numbers_sent_as_text_are_numbers(spark, folder):
    plan = {"parcel_id": "P1", "client_id": "C", "congestion_level": "0.5",
            "planned_pickup": "2024-01-01T08:00:00", "planned_delivery": "2024-01-01T12:00:00"}
    event = {"parcel_id": "P1", "event_type": "pickup", "event_timestamp": "2024-01-01T08:00:00",
             "latitude": "1.5", "longitude": 2}
    publish(spark, encoded([("planned_shipments", plan), ("delivery_events", event),
                            ("delivery_events", {**event, "latitude": "north"})]), f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out")
    assert tables.state.first()["congestion_level"] == 0.5
    assert [tuple(r) for r in tables.log.select("latitude", "longitude").collect()] == [(1.5, 2.0)]
    assert [r[0] for r in tables.errors.select("error_reason").collect()] == ["bad_number"]


def test_timeline_counts_every_event(spark, folder):
    messages = [m for m in interleaved(7) if m[0] == "delivery_events"]
    rows = encoded(messages)
    publish(spark, rows[:70], f"{folder}/in")
    publish(spark, rows[70:], f"{folder}/in")
    stream = topics.stream_file_topic(spark, f"{folder}/in", 1)
    timeline.start_timeline(stream, f"{folder}/out").awaitTermination()
    got = {(r["hour"], r["event_type"]): r["count"]
           for r in timeline.read_timeline(spark, f"{folder}/out").collect()}
    expected = Counter(
        (simulate.wall_time(p["event_timestamp"]).replace(minute=0, second=0, microsecond=0),
         p["event_type"]) for _, p in messages)
    assert got == dict(expected)


def test_repeated_event_ids_are_dropped_within_the_watermark(spark, folder):
    events = [("delivery_events", {
        "event_id": f"E{n % 3}", "parcel_id": "P1", "event_type": "pickup",
        "event_timestamp": datetime(2024, 1, 1, 0, n).isoformat(), "hub_id": "H"})
        for n in range(9)]
    publish(spark, encoded(events), f"{folder}/in")
    stream = topics.stream_file_topic(spark, f"{folder}/in", 1)
    usable = timeline.usable_events(stream).withColumn(
        "event_time", F.col("event_timestamp").cast("timestamp"))
    query = (
        timeline.dedup_stream(usable).select("event_id").writeStream.format("parquet")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/check")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{folder}/out").collect()) == ["E0", "E1", "E2"]
