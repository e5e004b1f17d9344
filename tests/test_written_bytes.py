"""What is written and shuffled between steps: no more than the next step needs."""

import glob
import os

from pyspark.sql import functions as F

from parceltide import constants as K
from parceltide.operators import features, recent
from parceltide.operators.ordinal import write_ranked
from parceltide.plans import catalog, store
from parceltide.plans.store import write_by_period
from parceltide.session import apply_session_conf, written
from parceltide.sources import files, testdata, topics
from parceltide.streaming import tower
from test_streaming import check, encoded, interleaved, publish, run_tower


def test_topic_files_are_compressed(spark, folder):
    rows = spark.range(50).select(
        F.lit("delivery_events").alias("topic"), F.col("id").cast("string").alias("key"),
        F.lit('{"a": "é\\n"}').alias("value"), F.col("id").alias("at_us"), F.lit(None).cast("string").alias("at_seq"))
    topics.publish_files(rows, f"{folder}/t")
    names = glob.glob(f"{folder}/t/part-*")
    assert names and all(n.endswith(".json.gz") for n in names)
    assert topics.read_file_topic(spark, f"{folder}/t").orderBy("at_us").collect() == rows.orderBy("at_us").collect()


def test_tables_between_steps_are_zstd(spark):
    names = written(apply_session_conf(spark).range(10), "step").inputFiles()
    assert names and all(".zstd." in n for n in names)


def test_years_are_written_without_a_shuffle(spark, folder):
    when = F.timestamp_add("DAY", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    rows = spark.range(1000).select("id", when.alias("event_timestamp"))
    for unit, shuffled in (("day", True), ("month", True), ("year", False)):
        plan = recent.dealt(rows.withColumn("p", F.lit(1)), "p", unit)._jdf.queryExecution().toString()
        assert ("Rebalance" in plan) == shuffled
    write_by_period(rows, "event_timestamp", f"{folder}/y", "year")
    found = spark.read.parquet(f"{folder}/y")
    assert found.count() == 1000 and {str(r[0]) for r in found.select("event_year").distinct().collect()} == {
        "2024-01-01", "2025-01-01", "2026-01-01"}


def test_messages_travel_to_the_log_only(spark, folder):
    """Events are joined and folded without their message; one plan version or several, the tables are the same."""
    messages = interleaved(7)
    publish(spark, encoded(messages), f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out")
    check(tables, messages)
    placed = spark.read.parquet(f"{folder}/out/placed/batch_id=0")
    assert "value" not in placed.columns and placed.count() == tables.log.filter("batch_id = 0").count()
    assert tables.log.filter("raw_payload IS NULL").count() == 0


def test_steps_are_dropped_once_a_batch_needs_them_no_more(spark, folder):
    messages = interleaved(8)
    rows = encoded(messages)
    for part in (rows[:60], rows[60:]):
        publish(spark, part, f"{folder}/in")
    tables = run_tower(spark, f"{folder}/in", f"{folder}/out", refresh_kpi=True, dedup_days=36_500.0, keep_steps=False)
    assert tables.published() == 1
    assert not any(tables.has(f"{step}/batch_id={n}") for step in tower._STEPS for n in (0, 1))
    kept = run_tower(spark, f"{folder}/in", f"{folder}/kept", refresh_kpi=True, dedup_days=36_500.0)
    assert sorted(map(str, tables.state.collect())) == sorted(map(str, kept.state.collect()))
    assert sorted(map(str, tables.kpis.collect())) == sorted(map(str, kept.kpis.collect()))


def test_tables_of_the_store_are_derived_when_they_are_read(spark, sf_dir, folder):
    apply_session_conf(spark)
    given = (testdata.planned_shipments(spark, sf_dir), testdata.delivery_events(spark, sf_dir),
             ("planned_pickup", "planned_delivery"))
    lazy = store.lazy_store(spark, f"{folder}/lazy", *given, log_unit="year")
    whole = store.build_store(spark, f"{folder}/whole", *given, log_unit="year")
    assert {os.path.basename(n) for n in glob.glob(f"{folder}/lazy/*")} == {"planned_shipments", "delivery_events_log"}
    assert lazy.periods("alerts") == whole.periods("alerts") and lazy.periods("error_logs") == whole.periods("error_logs")
    for name in ("plan", "state", "alerts", "errors"):
        a, b = (getattr(s, name).drop("updated_at") for s in (lazy, whole))
        assert a.columns == b.columns and a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_a_single_version_counts_from_its_arrival(spark):
    columns = "parcel_id string, at_us bigint, at_seq string"
    version = spark.createDataFrame([("A", 5, "b"), ("B", 5, "b")], columns).selectExpr(
        "parcel_id", "1L AS versions", "struct(at_us, at_seq, timestamp_ntz'2024-01-01 00:00:00' AS planned_pickup, "
        "timestamp_ntz'2024-01-02 00:00:00' AS planned_delivery, 'C' AS client_id, 'R' AS route_id) AS version")
    events = spark.createDataFrame(
        [("A", 4, "z"), ("A", 5, "a"), ("A", 5, "b"), ("A", 6, ""), ("N", 9, "")], columns)
    rows = tower.under_one_version(events.join(version, "parcel_id", "left")).orderBy("parcel_id", "at_us", "at_seq")
    assert [(r["known"], r["client_id"]) for r in rows.collect()] == [
        (False, None), (False, None), (True, "C"), (True, "C"), (False, None)]


def test_csv_files_are_compressed(spark, folder):
    rows = spark.range(20).select(F.col("id").cast("string").alias("a"), F.lit('x, y').alias("b"))
    files.write_csv(rows, f"{folder}/c")
    assert all(n.endswith(".csv.gz") for n in glob.glob(f"{folder}/c/part-*"))
    assert sorted(files.read_csv_text(spark, f"{folder}/c").collect()) == sorted(rows.collect())


def test_features_follow_the_ranking(spark, sf_dir):
    """Ranked training rows are written without the derived features and read back with them."""
    ranked = catalog._ranked(apply_session_conf(spark), sf_dir)
    assert set(K.FEATURE_COLUMNS) <= set(ranked.columns)
    stored = set(spark.read.parquet(*ranked.inputFiles()).columns)
    assert "composite_risk" not in stored and "route_enc" in stored


def test_years_are_written_without_a_sort(spark, sf_dir, folder):
    """A task keeps a file of each year open; sorting all its rows by year spilled most of them."""
    apply_session_conf(spark).sql(
        f"CREATE TABLE by_year (id bigint, event_year date) USING parquet PARTITIONED BY (event_year) LOCATION '{folder}/y'")
    try:
        text = spark.sql("EXPLAIN INSERT INTO by_year SELECT id, DATE'2024-01-01' + CAST(id AS int) FROM range(9)").first()[0]
    finally:
        spark.sql("DROP TABLE by_year")
    assert "WriteFiles" in text and "Sort" not in text
    # More periods than open files: the rest is sorted, no row is lost.
    when = F.timestamp_add("MONTH", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    write_by_period(spark.range(500).select("id", when.alias("event_timestamp")), "event_timestamp", f"{folder}/all", "year")
    found = spark.read.parquet(f"{folder}/all")
    assert found.count() == found.select("id").distinct().count() == 500
    assert found.filter("year(event_year) <> year(event_timestamp)").isEmpty()


def test_orders_meet_their_lines_without_texts(spark, sf_dir):
    text = testdata.delivery_events(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    above, _, below = text.partition("Join")
    assert "concat(FR" in above and "concat(FR" not in below
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:" in below


def _training_steps(monkeypatch):
    seen = {}

    def watched(df, purpose):
        seen[purpose] = df.columns
        return written(df, purpose)

    monkeypatch.setattr(features, "written", watched)
    return seen


def test_report_carries_what_labels_and_predictions_need(spark, sf_dir, monkeypatch):
    seen = _training_steps(monkeypatch)
    report = catalog.queries()["classification_report"](spark, sf_dir)
    assert set(seen["picked"]) == {"parcel_id", "planned_delivery", "route_id", "weather_condition", "congestion_level",
                                   "pickups", "actual_pickup", "delivered"}
    assert "LeftAnti" not in report._jdf.queryExecution().executedPlan().toString()


def test_training_rows_of_odd_parcels(spark):
    """No parcel number, plans sent twice, deliveries without a time, scans of unplanned parcels, no scans."""
    day = "timestamp_ntz'2024-01-01 00:00:00'"
    plan = spark.sql(f"SELECT explode(array('A', 'A', 'B', 'C', 'D', null)) AS parcel_id, {day} AS planned_delivery")
    events = spark.sql(f"""SELECT * FROM VALUES ('A', 'pickup', {day}), ('A', 'pickup', null), ('A', 'delivered', {day}),
        ('A', 'delivered', {day}), ('A', 'delivered', null), ('B', 'pickup', {day}), ('C', 'delivered', {day}), ('X', 'delivered', {day}),
        (null, 'delivered', {day}), (null, 'pickup', {day}), ('D', null, {day}) AS e(parcel_id, event_type, event_timestamp)""")
    got = sorted((str(r["parcel_id"]), r["actual_pickup"] is None, r["actual_delivery"] is None, r["copies"])
                 for r in features.training_set(plan, events).collect())
    assert got == [("A", False, False, 4), ("A", False, False, 4), ("A", False, True, 2), ("A", False, True, 2),
                   ("B", False, True, 1), ("C", True, False, 1), ("D", True, True, 1), ("None", True, True, 1)]


def test_ranked_rows_hold_what_is_read(spark, sf_dir):
    """Neither the hash that orders the rows nor plan columns that no feature reads are written."""
    ranked = catalog._ranked(apply_session_conf(spark), sf_dir)
    assert set(spark.read.parquet(*ranked.inputFiles()).columns) == {
        "parcel_id", "actual_delivery", "risk_label", "copies", "route_id", "planned_pickup", "planned_delivery",
        "weather_condition", "congestion_level", "distance_km", "weight_kg", "route_enc", "weather_enc", "client_enc", "hub_enc"}
    key = F.md5(F.concat_ws("|", "parcel_id", F.coalesce(F.col("actual_delivery").cast("string"), F.lit("-")), F.lit("42")))
    by_hash = {}
    for label, rank, _ in ranked.select("risk_label", "group_rank", key.alias("key")).orderBy("risk_label", "key").collect():
        by_hash.setdefault(label, []).append(rank)
    assert by_hash and all(ranks == list(range(len(ranks))) for ranks in by_hash.values())


def test_plans_sent_again_hold_what_an_upsert_takes(spark, sf_dir):
    sent = catalog._later_plans(spark, sf_dir)
    assert sent.columns == ["parcel_id", "client_id", "route_id", "hub_id", "planned_pickup", "planned_delivery",
                            "weather_condition", "congestion_level"]
    assert "distance_km" not in sent._jdf.queryExecution().optimizedPlan().toString()


def test_scans_are_split_finely_unless_the_cluster_says_otherwise(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        assert apply_session_conf(spark).conf.get(key) == "32m"
        spark.conf.set(key, "16m")
        assert apply_session_conf(spark).conf.get(key) == "16m"
    finally:
        spark.conf.set(key, before)


def test_ranked_rows_are_not_shuffled_again(spark, folder):
    """Whatever Spark thinks of the size of the counts per file."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = write_ranked(spark.range(1000).withColumn("g", F.col("id") % 2), "g", [F.md5(F.col("id").cast("string"))], folder)
        assert sorted(ranked.columns) == ["g", "group_rank", "group_size", "id"]
        assert {(r["g"], r["group_rank"]) for r in ranked.collect()} == {(g, n) for g in (0, 1) for n in range(500)}
        assert "SortMergeJoin" not in ranked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
