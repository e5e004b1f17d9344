"""Every registered query against its SQL, and the named-query interface."""

import pytest

import __spark_entry__ as entry
from compare import differences, duckdb_views
from parceltide.operators import store_queries as Q
from parceltide.plans import catalog
from parceltide.plans.named import named_queries, run_named_query
from parceltide import schemas
from pyspark.sql import functions as F

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duckdb_views(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) == []
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 7


@pytest.fixture(scope="module")
def store(spark, sf_dir):
    return catalog.store(spark, sf_dir)


def test_named_queries(store):
    for name in named_queries():
        df = run_named_query(store, name, {"limit": 3})
        assert df.count() <= (1 if name == "kpi_summary" else 3)
        assert not [f for f in df.dtypes if "timestamp" in f[1] or "decimal" in f[1]]


def test_named_query_filters(store):
    rows = run_named_query(store, "delayed_parcels", {
        "hub_id": "HUB_LYON", "client_id": "CLIENT_A", "status": "delivered", "limit": 1000,
        "severity": "high"}).collect()
    assert rows and all((r["hub_id"], r["client_id"], r["status"]) ==
                        ("HUB_LYON", "CLIENT_A", "delivered") for r in rows)
    # Values are data, never SQL.
    assert run_named_query(store, "client_parcels", {"client_id": "x' OR '1'='1"}).count() == 0
    severities = run_named_query(store, "recent_alerts", {"severity": "critical", "limit": 50})
    assert {r["severity"] for r in severities.collect()} == {"critical"}
    assert run_named_query(store, "client_parcels", {"limit": 10**6}).count() == store.state.count()


def test_unknown_names_are_refused(store):
    with pytest.raises(KeyError, match="unknown query"):
        run_named_query(store, "drop_tables")
    with pytest.raises(KeyError, match="unknown filters"):
        run_named_query(store, "hub_stats", {"colour": "red"})


def test_null_order_and_null_groups(spark):
    rows = [("A", None, 5.0), ("B", "H", None), ("C", "H", 99.0)]
    state = spark.createDataFrame(
        [(p, "c", "r", h, "accepted", None, None, None, None, d, "low", 0.0, "clear", 0.0)
         for p, h, d in rows], schemas.PARCEL_STATE)
    assert [r["parcel_id"] for r in Q.client_parcels(state).collect()] == ["B", "C", "A"]
    stats = {r["hub_id"]: r for r in Q.hub_stats(state).collect()}
    assert stats["H"]["total_parcels"] == 2 and stats["H"]["avg_delay_min"] == 99.0
    # A NULL delay is neither late nor on time.
    assert stats["H"]["on_time_pct"] == 0.0 and stats[None]["on_time_pct"] == 100.0


def test_alerts_of_unknown_parcels_stay(spark, store):
    alerts = store.alerts.limit(3).withColumn("parcel_id", F.col("alert_id"))
    rows = Q.recent_alerts(alerts, store.state).collect()
    assert len(rows) == 3 and all(r["hub_id"] is None for r in rows)
    feed = Q.alert_feed(alerts, store.state).collect()
    assert {r["hub_id"] for r in feed} == {"?"}
