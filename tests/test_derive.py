"""Band edges, rounding, messages and parsing."""

import pytest
from pyspark.sql import functions as F

import simulate
from parceltide.functions import aggregates, derive, parse, text
from parceltide.operators import correlate, golden, shaping, store_queries as Q
from parceltide import schemas

DELAYS = [-30.0, 0.0, 0.5, 15.0, 15.01, 30.0, 30.01, 60.0, 60.01, 104.9, 105.0, 120.0, 120.01, 500.0]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_risk_bands_and_severity(spark):
    d = F.col("d")
    rows = spark.createDataFrame([(x,) for x in DELAYS], "d double").select(
        "d", derive.risk_level(d), derive.risk_probability(d), derive.severity(d),
        derive.risk_label(d),
    ).collect()
    for delay, level, probability, severity, label in rows:
        assert (level, probability) == simulate.risk(delay)
        assert severity == simulate.severity(delay)
        assert label == ["low", "medium", "high"].index(level)


@pytest.mark.parametrize("delay", [0.5, 1.5, 2.5, 15.5, 16.5, 117.49])
def test_message_rounds_half_to_even(spark, delay):
    got = one(spark, derive.alert_message(F.lit("P"), F.lit(delay), F.lit("pickup")))[0]
    assert got == f"Colis P en retard de {delay:.0f} min (pickup)"


def test_round_double_is_correct_rounding(spark):
    values = [0.35, 0.25, 0.15, 2.675, 1.005, 0.6435, 0.45 * 1.3 * 1.1, 21.05, -0.35, 1234.55, 16.45]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (1, 2, 3):
        got = [r[0] for r in df.select(aggregates.round_double(F.col("v"), digits)).collect()]
        assert got == [round(v, digits) for v in values]


def test_percentage_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], schemas.PARCEL_STATE)
    row = Q.kpi_summary(empty).first()
    assert row["total_parcels"] == 0 and row["on_time_pct"] is None and row["avg_delay_min"] is None
    assert Q.kpi_sla(empty).first()["sla_gap_pct"] == -95.0


@pytest.mark.parametrize("value,expected,zoned", [
    ("2024-01-08T08:30:00", "2024-01-08 08:30:00", False),
    ("2024-01-08 08:30:00.5", "2024-01-08 08:30:00.5", False),
    ("2024-01-08T08:30:00Z", "2024-01-08 08:30:00", False),
    ("2024-01-08T08:30:00+02:00", "2024-01-08 08:30:00", True),
    ("garbage", None, False), ("", None, False), (None, None, False),
])
def test_wire_timestamp(spark, value, expected, zoned):
    column = F.lit(value).cast("string")
    got, is_zoned = one(spark, parse.timestamp(column).cast("string"), parse.is_zoned(column))
    assert (got, is_zoned) == (expected, zoned)


@pytest.mark.parametrize("value,valid", [
    ("2024-01-08T08:30:00", True), ("2024-01-08 08:30:00", True),
    ("2024-01-08T08:30:00.123456", True), ("2024-01-08 08:30:00.5", False),
    ("2024-01-08T08:30:00Z", False), ("2024-01-08", False), ("2024-13-08T08:30:00", False),
    ("0000-01-08T08:30:00", False), ("", False),
])
def test_replay_layouts(spark, value, valid):
    assert (one(spark, parse.replay_timestamp(F.lit(value)))[0] is not None) == valid


@pytest.mark.parametrize("value,expected", [
    ("1.5,2", (1.5, 2.0)), (" 1 , -2.5 ", (1.0, -2.5)), ("1", (None, None)),
    ("1,2,3", (None, None)), ("x,2", (None, None)), ("1,", (None, None)), (None, (None, None)),
])
def test_latlon(spark, value, expected):
    assert tuple(one(spark, parse.latlon(F.lit(value).cast("string")))[0]) == expected


@pytest.mark.parametrize("value,expected", [
    ("<think>a\nb</think> ok\n", "ok"), ("<think>a</think>x<think>b</think>y", "xy"),
    ("<think>open", "<think>open"), ("<think>a</think>  ", None), ("plain", "plain"),
])
def test_strip_think(spark, value, expected):
    assert one(spark, text.strip_think(F.lit(value)))[0] == expected


def test_delay_ignores_the_session_zone(spark):
    def ts(value):
        return F.lit(value).cast("timestamp_ntz")

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        got = one(spark, derive.minutes_between(ts("2024-03-31 01:30:00"), ts("2024-03-31 03:30:00")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got[0] == 120.0


def test_missing_plan_time_is_no_delay(spark):
    null = F.lit(None).cast("timestamp_ntz")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    for kind in ("pickup", "delivered", "scan"):
        assert one(spark, derive.event_delay(F.lit(kind), now, null, null))[0] == 0.0
    late = F.lit("2024-01-01 02:00:00").cast("timestamp_ntz")
    assert one(spark, derive.event_delay(F.lit("pickup"), late, now, now))[0] == 120.0
    assert one(spark, derive.event_delay(F.lit("pickup"), late, now, now, F.lit(True)))[0] == 0.0


def test_display_columns(spark):
    for level, shown, icon in [("critical", "critical", "🔴"), ("high", "high", "🔴"),
                               ("medium", "medium", "🟠"), ("low", "low", "🟢"),
                               ("odd", "low", "🟢"), (None, "low", "🟢")]:
        c = F.lit(level).cast("string")
        assert tuple(one(spark, derive.display_severity(c), derive.severity_icon(c))) == (shown, icon)
    for high, medium, colour in [(6, 0, "red"), (5, 11, "orange"), (5, 10, "green"),
                                 (None, None, "green")]:
        got = one(spark, derive.hub_colour(F.lit(high).cast("int"), F.lit(medium).cast("int")))[0]
        assert got == colour


def test_normalise_and_clean(spark):
    df = spark.sql("select cast(1.50 as decimal(5,2)) ` a `, date'2024-01-02' b, "
                   "timestamp_ntz'2024-01-02 03:04:05.25' c, 'x' d")
    row = shaping.normalise_result(shaping.clean_columns(df)).first().asDict()
    assert row == {"a": 1.5, "b": "2024-01-02", "c": "2024-01-02T03:04:05.250000", "d": "x"}


def test_message_counts_and_dedup(spark):
    plan = spark.sql("select 'A' parcel_id, 'c' client_id, 'r' route_id, "
                     "timestamp_ntz'2024-01-01 00:00:00' planned_pickup, "
                     "timestamp_ntz'2024-01-01 05:00:00' planned_delivery")
    events = spark.sql("""
        select 'e1' event_id, 'A' parcel_id, 'pickup' event_type, timestamp_ntz'2024-01-01 01:00:00' event_timestamp, 'h' hub_id
        union all select 'e1', 'A', 'pickup', timestamp_ntz'2024-01-01 01:00:00', 'h'
        union all select 'e2', 'B', 'pickup', timestamp_ntz'2024-01-01 01:00:00', 'h'""")
    assert tuple(correlate.message_counts(events, plan).first()) == (1, 3, 2, 1)
    assert correlate.alerts(events, plan).count() == 2
    assert correlate.dedup_events(events).count() == 2
    assert golden.fold_events(events).count() == 2
