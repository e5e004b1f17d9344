"""Adapter: the driver's order tables seen as planned shipments and delivery events.

The mapping is row-wise integer arithmetic over whole tables (see FIXTURES.md), so it needs no
window and no shuffle beyond the order join, and any engine reproduces it to the microsecond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from parceltide import constants as K
from parceltide.functions import derive

# --- fixed values: the route of an order is ROUTE_SEED[o_orderkey % 7] ---
_ROUTE_MINUTES = [270, 450, 360, 150, 210, 240, 300]
_FACTOR_TENTHS = {"clear": 10, "rain": 13, "fog": 12, "snow": 18, "storm": 25}
_CLIENTS = [row[0] for row in K.CLIENT_SEED]
_HUB_BY_CITY = {row[2]: row[0] for row in K.HUB_SEED}

# --- fixed values: event type of a line number, and its shift in minutes against the plan ---
_EVENT_TYPES = ["accepted", "pickup", "in_transit", "delivered", "delivered", "pickup", "scan"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def order_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transport plan of every order, whether or not it is released."""
    return with_plans(table(spark, sf_dir, "orders"))


def with_plans(orders: DataFrame, *keep: str) -> DataFrame:
    """Order rows mapped to their plans, with the columns in ``keep`` in front."""
    k = F.col("o_orderkey")
    route = k % 7
    origins = [_HUB_BY_CITY[row[1]] for row in K.ROUTE_SEED]
    targets = [_HUB_BY_CITY[row[2]] for row in K.ROUTE_SEED]
    weather = (
        F.when(k % 20 < 10, "clear")
        .when(k % 20 < 15, "rain")
        .when(k % 20 < 17, "fog")
        .when(k % 20 < 19, "snow")
        .otherwise("storm")
    )
    congestion = (k * 37 + 11) % 101
    tenths = derive.case(
        [(F.col("_weather") == name, F.lit(value).cast("bigint"))
         for name, value in _FACTOR_TENTHS.items()], F.lit(None).cast("bigint"))
    staged = orders.select(
        *keep, k.alias("order_key"),
        F.concat(F.lit("FR"), (k + 100000).cast("string")).alias("parcel_id"),
        _pick(_CLIENTS, F.col("o_custkey") % 5).alias("client_id"),
        _pick([row[0] for row in K.ROUTE_SEED], route).alias("route_id"),
        _pick(origins, route).alias("hub_id"),
        _pick(targets, route).alias("dest_hub_id"),
        F.timestamp_add("MINUTE", ((k * 53) % 1440).cast("int"), F.col("o_orderdate")).alias(
            "planned_pickup"
        ),
        weather.alias("_weather"),
        congestion.alias("_c"),
        _pick(_ROUTE_MINUTES, route).cast("bigint").alias("_avg"),
        (200 + (k * 61) % 700).cast("double").alias("distance_km"),
        ((10 + (k * 7919) % 4991) / F.lit(100.0)).alias("weight_kg"),
        # Low-priority orders that are still pending have no transport plan yet.
        ((F.col("o_orderstatus") != "P") | (F.col("o_orderpriority") != "5-LOW")).alias("released"),
    )
    duration = F.floor(
        F.col("_avg") * tenths * (1000 + 3 * F.col("_c")) / 10000
    ).cast("int")
    return staged.withColumn("duration_min", duration).select(
        *keep, "order_key", "parcel_id", "client_id", "route_id", "hub_id", "dest_hub_id",
        "planned_pickup",
        F.timestamp_add("MINUTE", F.col("duration_min"), F.col("planned_pickup")).alias(
            "planned_delivery"
        ),
        F.col("_weather").alias("weather_condition"),
        (F.col("_c") / F.lit(100.0)).alias("congestion_level"),
        "distance_km", "weight_kg", "duration_min", "released",
    )


def planned_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_plans(spark, sf_dir).filter("released").drop(
        "order_key", "duration_min", "released"
    )


def delivery_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery event per order line; lines of unreleased orders are unknown parcels. Orders meet their lines
    as keys and dates, and plans follow from them after the join, so their texts are not shuffled."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey"),
        F.col("l_linenumber").alias("line"),
        ((F.col("l_partkey") * 31 + F.col("l_suppkey") * 17) % 241 - 60).cast("int").alias("d"),
    )
    ordered = lines.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    planned = with_plans(ordered, "line", "d")
    line, d, dur = F.col("line"), F.col("d"), F.col("duration_min")
    shift = (
        F.when(line == 1, -60)
        .when(line == 2, d)
        .when(line == 3, d + F.floor(dur * 2 / 5).cast("int"))
        .when(line == 4, dur + d)
        .when(line == 5, dur + d + 5)
        .when(line == 6, d + 5)
        .otherwise(dur + d + 70)
    )
    at_origin = line.isin(1, 2, 3, 6)
    hub = F.when(at_origin, F.col("hub_id")).otherwise(F.col("dest_hub_id"))
    lat = {row[0]: row[3] for row in K.HUB_SEED}
    lon = {row[0]: row[4] for row in K.HUB_SEED}
    events = planned.select(
        "parcel_id",
        _pick(_EVENT_TYPES, line - 1).alias("event_type"),
        F.timestamp_add("MINUTE", shift, F.col("planned_pickup")).alias("event_timestamp"),
        hub.alias("hub_id"),
    )
    return events.select(
        derive.event_id(
            F.col("parcel_id"), F.col("event_type"), F.col("event_timestamp")
        ).alias("event_id"),
        "parcel_id", "event_type", "event_timestamp", "hub_id",
        derive.lookup(F.col("hub_id"), lat, 0.0).alias("latitude"),
        derive.lookup(F.col("hub_id"), lon, 0.0).alias("longitude"),
    )
