"""The operational questions asked of the store.

Every function takes DataFrames and returns one. Filters that are not given are not added to the
plan at all, group-bys run over a handful of keys with map-side partial aggregation, and every
ranking ends in a key so that ``LIMIT`` is deterministic. The rankings keep the store's null
order: descending puts NULL first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parceltide import constants as K
from parceltide.functions import aggregates as A, derive
from parceltide.operators.recent import Periods, newest
from parceltide.session import written


def _late() -> Column:
    return F.col("delay_minutes") > K.LOW_MAX_MIN


def _on_time() -> Column:
    return F.col("delay_minutes") <= K.LOW_MAX_MIN


def where_equal(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Keep rows equal to every given value; parameters left out filter nothing."""
    for column, value in wanted.items():
        if value:
            df = df.filter(F.col(column) == F.lit(value))
    return df


def ranked(df: DataFrame, by: list[str], tiebreak: list[str], limit: int | None) -> DataFrame:
    order = [F.col(c).desc_nulls_first() for c in by] + [F.col(c).asc_nulls_last() for c in tiebreak]
    df = df.orderBy(*order)
    return df if limit is None else df.limit(limit)


def _counts(**conditions: Column) -> list[Column]:
    return [F.count_if(condition).alias(name) for name, condition in conditions.items()]


def _on_time_pct() -> Column:
    return A.percentage(F.count_if(_on_time()), F.count(F.lit(1))).alias("on_time_pct")


def _average_delay(name: str) -> Column:
    return A.average(F.col("delay_minutes")).alias(name)


# --- parcels ---------------------------------------------------------------------------------


def delayed_parcels(state: DataFrame, hub_id: str | None = None, client_id: str | None = None,
                    status: str | None = None, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = where_equal(state.filter(_late()), hub_id=hub_id, client_id=client_id, status=status)
    rows = rows.select("parcel_id", "client_id", "hub_id", "route_id", "status", "delay_minutes",
                       "risk_level", "planned_delivery", "actual_delivery")
    return ranked(rows, ["delay_minutes"], ["parcel_id"], limit)


def at_risk_parcels(state: DataFrame, hub_id: str | None = None, client_id: str | None = None,
                    status: str | None = None, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = state.filter(F.col("risk_level").isin("medium", "high")
                        & ~F.col("status").isin("delivered"))
    rows = where_equal(rows, hub_id=hub_id, client_id=client_id, status=status)
    rows = rows.select("parcel_id", "client_id", "hub_id", "route_id", "status", "risk_level",
                       "risk_probability", "delay_minutes")
    return ranked(rows, ["risk_probability", "delay_minutes"], ["parcel_id"], limit)


def risk_or_late_parcels(state: DataFrame, limit: int = 50) -> DataFrame:
    """Ranked by the delay as displayed, that is after rounding to whole minutes."""
    rows = state.filter(F.col("risk_level").isin("medium", "high") | _late()).select(
        "parcel_id", "client_id", "hub_id", "route_id", "status", "risk_level",
        A.round_half_up(F.col("delay_minutes"), 0).alias("delay_min"), "planned_delivery",
    )
    return ranked(rows, ["delay_min"], ["parcel_id"], limit)


def client_parcels(state: DataFrame, client_id: str | None = None, status: str | None = None,
                   limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = where_equal(state, client_id=client_id, status=status).select(
        "parcel_id", "hub_id", "route_id", "status", "risk_level", "delay_minutes",
        "planned_delivery",
    )
    return ranked(rows, ["delay_minutes"], ["parcel_id"], limit)


# --- aggregates over the state ---------------------------------------------------------------


def kpi_summary(state: DataFrame) -> DataFrame:
    status = F.col("status")
    return state.agg(
        F.count(F.lit(1)).alias("total_parcels"),
        *_counts(
            delivered=status == "delivered",
            in_transit=~status.isin("delivered", "planned"),
            delayed=_late(),
            high_risk=F.col("risk_level") == "high",
        ),
        _average_delay("avg_delay_min"),
        _on_time_pct(),
    )


def kpi_sums(state: DataFrame) -> DataFrame:
    """Whole numbers behind the KPI row. They add up over parts of the state, and the delay does so exactly, in
    microseconds."""
    status = F.col("status")
    counts = _counts(
        total_parcels=F.lit(True), delivered=status == "delivered",
        in_transit=~status.isin("delivered", "planned"), delayed=_late(),
        high_risk=F.col("risk_level") == "high", on_time=_on_time(),
    )
    delay = F.rint(F.col("delay_minutes") * 60_000_000).cast("decimal(38,0)")
    return state.agg(*counts, F.coalesce(F.sum(delay), F.lit(0)).cast("decimal(38,0)").alias("delay_us"))


def kpi_of_sums(sums: DataFrame) -> DataFrame:
    """The KPI row of added-up ``kpi_sums``, with those next to it."""
    total = F.col("total_parcels")
    mean = F.col("delay_us").cast("double") / 60_000_000 / F.nullif(total, F.lit(0))
    return sums.select(
        total, "delivered", "in_transit", "delayed", "high_risk",
        A.round_half_up(mean, 1).alias("avg_delay_min"),
        A.percentage(F.col("on_time"), total).alias("on_time_pct"),
        F.struct(*sums.columns).alias("sums"),
    )


def kpi_sla(state: DataFrame) -> DataFrame:
    """On-time share against the SLA target; an empty store counts as 0 %."""
    on_time = F.coalesce(F.col("on_time_pct"), F.lit(0.0))
    return kpi_summary(state).select(
        on_time.alias("on_time_pct"),
        F.lit(K.SLA_TARGET_PCT).alias("sla_target_pct"),
        F.round(on_time - K.SLA_TARGET_PCT, 1).alias("sla_gap_pct"),
    )


def hub_stats(state: DataFrame, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = state.groupBy("hub_id").agg(
        F.count(F.lit(1)).alias("total_parcels"),
        *_counts(delivered=F.col("status") == "delivered", delayed=_late(),
                 high_risk=F.col("risk_level") == "high"),
        _average_delay("avg_delay_min"),
        _on_time_pct(),
    )
    return ranked(rows, ["high_risk", "avg_delay_min"], ["hub_id"], limit)


def hub_risk(state: DataFrame) -> DataFrame:
    return state.groupBy("hub_id").agg(
        F.count(F.lit(1)).alias("total"),
        *_counts(high_risk=F.col("risk_level") == "high",
                 medium_risk=F.col("risk_level") == "medium"),
        _average_delay("avg_delay"),
        _on_time_pct(),
    )


def hub_map(state: DataFrame, hubs: DataFrame) -> DataFrame:
    """Every known hub with its marker colour; hubs without parcels keep NULL statistics."""
    return hubs.select("hub_id", "hub_name", "latitude", "longitude").join(
        hub_risk(state), "hub_id", "left"
    ).select(
        "hub_id", "hub_name", "latitude", "longitude", "total", "high_risk", "medium_risk",
        "avg_delay", "on_time_pct",
        derive.hub_colour(F.col("high_risk"), F.col("medium_risk")).alias("colour"),
    )


def route_stats(state: DataFrame, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = state.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("total"),
        _average_delay("avg_delay_min"),
        *_counts(high_risk_count=F.col("risk_level") == "high"),
        _on_time_pct(),
    )
    return ranked(rows, ["avg_delay_min"], ["route_id"], limit)


def route_delays(state: DataFrame) -> DataFrame:
    rows = state.filter(F.col("route_id").isNotNull()).groupBy("route_id").agg(
        _average_delay("avg_delay"), *_counts(delayed_count=_late()), _on_time_pct(),
    )
    return ranked(rows, ["avg_delay"], ["route_id"], None)


def route_lines(state: DataFrame, routes: DataFrame, hubs: DataFrame) -> DataFrame:
    """End points of every route on the map with the parcels it carries. The parcels are counted
    before the dimension lookups, so those join a few rows per side."""
    def end(prefix: str, city: str) -> DataFrame:
        return hubs.select(
            F.col("city").alias(city),
            F.col("hub_id").alias(f"{prefix}_hub"),
            F.col("latitude").alias(f"{prefix}_lat"),
            F.col("longitude").alias(f"{prefix}_lon"),
        )

    carried = state.groupBy("route_id").agg(F.count(F.lit(1)).alias("parcels"))
    return (
        routes.select("route_id", "origin", "destination")
        .join(end("from", "origin"), "origin")
        .join(end("to", "destination"), "destination")
        .join(carried, "route_id", "left")
        .select("route_id", "from_hub", "from_lat", "from_lon", "to_hub", "to_lat", "to_lon",
                F.coalesce("parcels", F.lit(0)).alias("parcels"))
    )


def risk_distribution(state: DataFrame) -> DataFrame:
    return state.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))


def parcels_by_status(state: DataFrame, limit: int = K.DEFAULT_LIMIT) -> DataFrame:
    rows = state.groupBy("status", "risk_level").agg(F.count(F.lit(1)).alias("count"))
    return ranked(rows, ["count"], ["status", "risk_level"], limit)


# --- alerts ----------------------------------------------------------------------------------


def _alert_page(alerts: DataFrame, state: DataFrame, severity: str | None, limit: int | None,
                parcel_columns: list[str], periods: Periods | None) -> DataFrame:
    """Latest open alerts with columns of their parcel; alerts of unknown parcels stay.

    The join neither drops nor repeats alerts, so the page is cut before it and written: the alerts
    are scanned once, and Spark knows the page's size when it decides how to join it.
    """
    rows = where_equal(alerts.filter(~F.col("acknowledged")), severity=severity)
    rows = rows.drop(*[c for c in parcel_columns if c in alerts.columns])
    page = ranked(newest(rows, periods, limit), ["created_at"], ["alert_id", "message"], limit)
    if limit is not None:
        page = written(page, "alert-page")
    keys = page.select("parcel_id").distinct()
    parcels = state.select("parcel_id", *parcel_columns).join(keys, "parcel_id", "left_semi")
    return page.join(parcels, "parcel_id", "left")


def recent_alerts(alerts: DataFrame, state: DataFrame, severity: str | None = None,
                  limit: int | None = K.DEFAULT_LIMIT, periods: Periods | None = None) -> DataFrame:
    page = _alert_page(alerts, state, severity, limit, ["hub_id", "client_id", "route_id"], periods)
    rows = page.select("alert_id", "parcel_id", "alert_type", "severity", "message",
                       "created_at", "acknowledged", "hub_id", "client_id", "route_id")
    return ranked(rows, ["created_at"], ["alert_id", "message"], None)


def active_alerts(alerts: DataFrame, state: DataFrame, limit: int | None = K.DEFAULT_LIMIT,
                  periods: Periods | None = None) -> DataFrame:
    page = _alert_page(alerts, state, None, limit, ["hub_id", "client_id"], periods)
    return ranked(page, ["created_at"], ["alert_id", "message"], None).select(
        "severity", "message", "created_at", "hub_id", "client_id"
    )


def alert_feed(alerts: DataFrame, state: DataFrame, limit: int | None = K.DEFAULT_LIMIT,
               periods: Periods | None = None) -> DataFrame:
    """Open alerts as the feed displays them."""
    return active_alerts(alerts, state, limit, periods).select(
        derive.display_severity(F.col("severity")).alias("severity"),
        derive.severity_icon(F.col("severity")).alias("icon"),
        F.coalesce("hub_id", F.lit("?")).alias("hub_id"),
        F.coalesce("client_id", F.lit("?")).alias("client_id"),
        F.substring("message", 1, K.MESSAGE_DISPLAY_CHARS).alias("message"),
        F.substring(F.col("created_at").cast("string"), 1, K.TIMESTAMP_DISPLAY_CHARS).alias(
            "created_at"
        ),
    )


# --- events and errors -----------------------------------------------------------------------


def event_journal(log: DataFrame, event_type: str | None = None, hub_id: str | None = None,
                  limit: int | None = 50, periods: Periods | None = None) -> DataFrame:
    rows = newest(where_equal(log, event_type=event_type, hub_id=hub_id), periods, limit).select(
        "parcel_id", "event_type", "event_timestamp", "hub_id", "latitude", "longitude",
        *[c for c in ("ingested_at",) if c in log.columns],
    )
    return ranked(rows, ["event_timestamp"], ["parcel_id", "event_type", "hub_id"], limit)


def event_timeline(log: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("event_timestamp")).cast("timestamp_ntz")
    return log.groupBy(hour.alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("count"))


def recent_errors(dead_letters: DataFrame, limit: int | None = 20,
                  periods: Periods | None = None) -> DataFrame:
    rows = newest(dead_letters, periods, limit)
    if periods is not None:
        rows = rows.drop(periods.column)
    return ranked(rows, ["created_at"], ["raw_message"], limit)
