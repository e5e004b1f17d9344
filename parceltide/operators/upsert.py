"""Keyed upserts of the store tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parceltide import constants as K, schemas

_OVERWRITTEN = ("planned_pickup", "planned_delivery", "weather_condition", "congestion_level")


def upsert_planned(state: DataFrame, plan: DataFrame) -> DataFrame:
    """Golden records after plan rows arrive (``plan`` has one row per parcel, see ``fold_plan``).

    A new parcel is inserted as planned. A known one gets the new times, weather and congestion
    and goes back to planned; client, route, hub, actual times, delay and risk stay. If the state says
    when a row was updated, rows that were sent are updated now. One row meets one row, so the full
    join cannot be skewed by a busy parcel.
    """
    dated = [c for c in ("updated_at",) if c in state.columns]
    new = plan.select(
        F.col("parcel_id"), F.lit(True).alias("sent"),
        *[F.col(c).alias(f"new_{c}") for c in ("client_id", "route_id", "hub_id", *_OVERWRITTEN)],
    )
    old = state.select(*schemas.PARCEL_STATE.names, *dated, F.lit(True).alias("stored"))
    sent = F.coalesce(F.col("sent"), F.lit(False))
    stored = F.coalesce(F.col("stored"), F.lit(False))
    defaults = {"delay_minutes": F.lit(0.0), "risk_level": F.lit("low"),
                "risk_probability": F.lit(0.0)}

    def merged(name: str):
        if name == "status":
            return F.when(sent, K.INITIAL_STATUS).otherwise(F.col("status"))
        if name == "updated_at":
            return F.when(sent, F.current_timestamp()).otherwise(F.col(name))
        if name in _OVERWRITTEN:
            return F.when(sent, F.col(f"new_{name}")).otherwise(F.col(name))
        if name in ("client_id", "route_id", "hub_id"):
            return F.when(stored, F.col(name)).otherwise(F.col(f"new_{name}"))
        if name in defaults:
            return F.when(stored, F.col(name)).otherwise(defaults[name])
        return F.col(name)

    joined = old.join(new, "parcel_id", "full")
    return joined.select(*[merged(c).alias(c) for c in (*schemas.PARCEL_STATE.names, *dated)])


def insert_if_absent(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """``existing`` plus the seed rows whose key it does not have. A seed is a small list: the
    semi join reduces the existing table to the few keys that matter before the anti join."""
    taken = existing.join(seed.select(key), key, "left_semi").select(key).distinct()
    return existing.unionByName(seed.join(taken, key, "left_anti"))
