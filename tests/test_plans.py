"""The plans: what reaches the scan, what is shuffled, and that a busy key is split."""

import re

import pytest
from pyspark.sql import functions as F

from parceltide.functions import derive
from parceltide.operators import correlate, features, golden, ordinal, store_queries as Q
from parceltide.operators.recent import listed, newest
from parceltide.plans import catalog
from parceltide.plans.store import write_by_period
from parceltide.session import written
from parceltide.sources import seeds
from parceltide.streaming import tower


def planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def set_conf(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            changed[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield set_conf
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Events of which a third belongs to one parcel, and the plan, as files."""
    path = str(tmp_path_factory.mktemp("skew"))
    parcel = F.when(F.col("id") % 3 == 0, "HOT").otherwise(
        F.concat(F.lit("P"), (F.col("id") % 2000).cast("string")))
    minute = F.timestamp_add("SECOND", (F.col("id") % 500_000).cast("int"),
                             F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    events = spark.range(0, 120_000, 1, 8).select(
        F.concat(F.lit("E"), "id").alias("event_id"), parcel.alias("parcel_id"),
        F.when(F.col("id") % 2 == 0, "delivered").otherwise("pickup").alias("event_type"),
        minute.alias("event_timestamp"), F.lit("H").alias("hub_id"),
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"),
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    plan = events.select("parcel_id").distinct().filter("parcel_id <> 'P7'").select(
        "parcel_id", F.lit("C").alias("client_id"), F.lit("R_PAR_LYO").alias("route_id"),
        F.lit("H").alias("hub_id"), F.lit("D").alias("dest_hub_id"),
        start.alias("planned_pickup"), start.alias("planned_delivery"),
        F.lit("rain").alias("weather_condition"), F.lit(0.5).alias("congestion_level"),
        F.lit(10.0).alias("distance_km"), F.lit(1.0).alias("weight_kg"),
    )
    events.write.parquet(f"{path}/events")
    plan.write.parquet(f"{path}/plan")
    return spark.read.parquet(f"{path}/events"), spark.read.parquet(f"{path}/plan")


@pytest.fixture
def skew_conf(conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def merged_stream(events, plan, path, versions=1):
    """A micro-batch's merged table of the events and ``versions`` plans of each parcel, an hour apart."""
    rows = events.select(
        F.lit("delivery_events").alias("topic"), "parcel_id", "event_id", "event_type", "event_timestamp", "hub_id",
        derive.micros(F.col("event_timestamp")).alias("at_us"), F.col("event_id").alias("at_seq"),
    )
    number = F.explode(F.sequence(F.lit(0), F.lit(versions - 1))).alias("n")
    start = F.lit(1_704_067_200_000_000)
    plans = plan.select("*", number).select(
        "parcel_id", "client_id", "route_id", F.timestamp_add("MINUTE", F.col("n"), F.col("planned_pickup")).alias(
            "planned_pickup"), "planned_delivery",
        (start + F.col("n") * 3_600_000_000).alias("at_us"), F.lit("").alias("at_seq"))
    none = plan.sparkSession.createDataFrame([], tower._FACTS)
    tower.write_merged(none, plans, rows, path)
    return plan.sparkSession.read.parquet(path)


@pytest.mark.parametrize("name", ["correlate", "alerts", "dead_letters", "training"])
def test_busy_parcel_is_split(spark, skewed, skew_conf, folder, name):
    events, plan = skewed
    df = {
        "correlate": lambda: correlate.correlate_events(events, plan),
        "alerts": lambda: correlate.alerts(events, plan),
        "dead_letters": lambda: correlate.dead_letters(events, plan),
        "training": lambda: features.training_set(plan, events),
    }[name]()
    rows = df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    expected = {
        "correlate": 120_000,
        "dead_letters": events.filter("parcel_id = 'P7'").count(),
    }
    if name in expected:
        assert len(rows) == expected[name]


def test_stream_cuts_a_busy_parcel_by_time(skewed, folder, conf):
    """Events meet 2,000 plan versions of a parcel in one sorted merge; no task takes the busy parcel whole."""
    conf(spark__sql__shuffle__partitions="8", spark__sql__adaptive__coalescePartitions__enabled="false")
    events, plan = skewed
    merged = merged_stream(events, plan.filter("parcel_id IN ('HOT', 'P1', 'P2')"), f"{folder}/merged", 2000)
    parts = {r["part"]: r["n"] for r in merged.filter("parcel_id = 'HOT'").groupBy("part").agg(
        F.count("*").alias("n")).collect()}
    assert len(parts) >= 2 and max(parts.values()) < 0.6 * sum(parts.values())
    found = tower.plan_in_force(merged)
    assert "Join" not in re.sub(r"BroadcastHashJoin", "", planned(found))  # no interval join, no shuffled one
    rows = found.select("parcel_id", "at_us", "known", "planned_pickup", "event_id").collect()
    assert len(rows) == 120_000
    first = 1_704_067_200_000_000
    for r in rows:
        if r["parcel_id"] not in ("HOT", "P1", "P2"):
            assert not r["known"]
            continue
        version = min((r["at_us"] - first) // 3_600_000_000, 1999)
        assert r["planned_pickup"].hour * 60 + r["planned_pickup"].minute == version % 1440, r


def test_fold_sends_one_row_per_parcel_and_input_partition(spark, skewed):
    events, plan = skewed
    text = planned(golden.golden_record(plan, events))
    before_shuffle = re.search(r"Exchange hashpartitioning\(parcel_id.*?\n(.*?)partial_max",
                               text, re.S)
    assert before_shuffle, text
    assert golden.golden_record(plan, events).filter("parcel_id = 'HOT'").count() == 1


def test_training_rows_scan_the_log_once_and_split_the_busy_join(spark, skewed, skew_conf, monkeypatch):
    events, plan = skewed
    seen = []

    def watched(df, purpose):
        seen.append((purpose, planned(df)))
        return written(df, purpose)

    monkeypatch.setattr(features, "written", watched)
    rows = features.training_set(plan, events)
    rows.collect()
    plans = [text for _, text in seen] + [planned(rows)]
    assert sum(text.count("event_type") > 0 and "/events" in text for text in plans) == 1
    assert [purpose for purpose, _ in seen] == ["scans", "picked"]
    # Of the two joins left, the inner one meets the busy rows; the other meets one row per parcel on either side.
    final = rows._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in final.splitlines() if "SortMergeJoin" in line]
    assert any("Inner" in line and "skew=true" in line for line in joins), joins
    assert all("Inner" in line or "LeftAnti" in line for line in joins)


def test_training_copies_stand_for_the_pairs(spark, skewed):
    events, plan = skewed
    training = features.training_set(plan, events)
    scans = events.groupBy("parcel_id").agg(
        F.count_if(F.col("event_type") == "pickup").alias("p"),
        F.count_if(F.col("event_type") == "delivered").alias("d"))
    pairs = plan.join(scans, "parcel_id").agg(
        F.sum(F.greatest("p", F.lit(1)) * F.greatest("d", F.lit(1)))).first()[0]
    assert training.agg(F.sum("copies")).first()[0] == pairs


def test_exact_ranks_of_a_class_with_most_rows(spark, skewed, folder):
    events, _ = skewed
    rows = events.select("event_id", F.when(F.col("parcel_id") == "P1", 1).otherwise(0).alias("g"))
    ranked = ordinal.write_ranked(rows, "g", ["event_id"], f"{folder}/ranked")
    stats = ranked.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("group_rank").alias("u"),
        F.min("group_rank").alias("lo"), F.max("group_rank").alias("hi"),
        F.max("group_size").alias("size")).collect()
    assert len(stats) == 2
    for row in stats:
        assert (row["u"], row["lo"], row["hi"], row["size"]) == (row["n"], 0, row["n"] - 1, row["n"])
    # The rank follows the order within the group.
    first = ranked.filter("g = 0").orderBy("event_id").limit(50).select("group_rank").collect()
    assert [r[0] for r in first] == list(range(50))


@pytest.mark.parametrize("name,pushed", [
    ("delayed_parcels", "GreaterThan(delay_minutes,15.0)"),
    ("at_risk_parcels", "In(risk_level, [high,medium])"),
    ("client_parcels", "EqualTo(client_id,CLIENT_B)"),
    ("event_journal", "EqualTo(event_type,delivered)"),
])
def test_filters_reach_the_scan_and_rankings_stay_bounded(spark, sf_dir, name, pushed):
    df = catalog.queries()[name](spark, sf_dir)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert pushed in text, text
    assert "TakeOrderedAndProject" in text


def test_kpi_reads_three_columns(spark, sf_dir):
    text = planned(catalog.queries()["kpi_summary"](spark, sf_dir))
    assert "ReadSchema: struct<status:string,delay_minutes:double,risk_level:string>" in text


def test_alert_page_does_not_shuffle_the_state(spark, sf_dir):
    store = catalog.store(spark, sf_dir)
    periods = store.periods("alerts")
    page = Q.recent_alerts(store.alerts, store.state, periods=periods)
    text = planned(page)
    lines = text.splitlines()
    scans = [n for n, line in enumerate(lines) if "FileScan" in line]
    of_state = [n for n in scans if "message" not in lines[n] and "client_id" in lines[n]]
    # The alerts were scanned once, before: what is left reads the page, its keys and the state.
    assert len(scans) == 3 and len(of_state) == 1 and not any("acknowledged#" in lines[n] and
                                                              "PartitionFilters: [is" in lines[n] for n in scans)
    above = "\n".join(lines[max(0, of_state[0] - 4):of_state[0]])
    assert "BroadcastHashJoin" in above and "LeftSemi" in above and "Exchange hashpartitioning" not in above, text
    key = ["created_at", "alert_id", "message"]
    small = Q.recent_alerts(store.alerts, store.state, limit=200, periods=periods).orderBy(*key).collect()
    wide = Q.recent_alerts(store.alerts, store.state, limit=None, periods=periods)
    same = wide.orderBy(F.col("created_at").desc(), "alert_id", "message").limit(200)
    assert small == same.orderBy(*key).collect()


@pytest.fixture(scope="module")
def daily(spark, tmp_path_factory):
    """A log of 40 days with a hundred events each, one rare type on the oldest day, some without a time."""
    path = str(tmp_path_factory.mktemp("daily"))
    when = F.timestamp_add("MINUTE", (F.col("id") * 13).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = spark.range(4000).select(
        F.concat(F.lit("P"), "id").alias("parcel_id"),
        F.when(F.col("id") == 5, "rare").otherwise("pickup").alias("event_type"), when.alias("event_timestamp"),
        F.lit("H").alias("hub_id"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"))
    write_by_period(rows, "event_timestamp", path)
    return spark.read.parquet(path), listed(spark, path)


def test_journal_reads_the_newest_days_only(daily):
    log, periods = daily
    assert periods.column == "event_day" and periods.newest_first == sorted(periods.newest_first, reverse=True)
    page = Q.event_journal(log, limit=50, periods=periods)
    filters = re.search(r"PartitionFilters: \[(.*?)\]", planned(page))[1]
    assert f">= {periods.newest_first[3]}" in filters  # the newest day holds less than a page
    assert page.collect() == Q.event_journal(log, limit=50).collect()


def test_a_rare_filter_reaches_the_oldest_day(daily):
    log, periods = daily
    for limit in (1, 3):
        page = Q.event_journal(log, event_type="rare", limit=limit, periods=periods).collect()
        assert [r["parcel_id"] for r in page] == ["P5"]
    assert newest(log, periods, 10 ** 6).count() == 4000
    assert newest(log, periods, None).count() == newest(log, None, 5).count() == 4000


def test_rows_without_a_time_rank_first(spark, daily, folder):
    log, _ = daily
    odd = log.drop("event_day").withColumn(
        "event_timestamp", F.when(F.col("parcel_id") != "P7", F.col("event_timestamp")))
    write_by_period(odd, "event_timestamp", folder, "month")
    periods = listed(spark, folder)
    assert periods.column == "event_month" and len(periods.newest_first) == 2
    page = Q.event_journal(spark.read.parquet(folder), limit=2, periods=periods).collect()
    assert [r["event_timestamp"] is None for r in page] == [True, False] and page[0]["parcel_id"] == "P7"


def test_context_is_limited_before_the_shuffle(spark, sf_dir):
    text = planned(catalog.queries()["chat_context"](spark, sf_dir))
    shuffled = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffled:]


def test_dimensions_are_broadcast_by_their_size(spark, sf_dir):
    store = catalog.store(spark, sf_dir)
    text = planned(catalog.queries()["route_profile"](spark, sf_dir))
    assert "BroadcastHashJoin" in text
    assert seeds.hubs(spark).count() == 7 and store.routes.count() == 7


def test_no_python_in_batch_plans(spark, sf_dir):
    for name, query in catalog.queries().items():
        if name.startswith("stream_") or name in ("train_risk_model", "score_parcels",
                                                  "feature_importance"):
            continue
        text = planned(query(spark, sf_dir))
        for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "InPandas", "Cartesian"):
            assert node not in text, (name, node)
