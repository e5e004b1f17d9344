"""The table store: plan, event log, parcel state, alerts and dead letters as parquet.

Deriving the golden record is the expensive step, so it is written once and every dashboard
query reads the table. The store lies in the shared folder, not in executor memory: losing an
executor loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from parceltide import schemas
from parceltide.operators import correlate, golden, recent
from parceltide.session import removed, written
from parceltide.sources import seeds


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    @property
    def plan(self) -> DataFrame:
        return self.table("planned_shipments")

    @property
    def events(self) -> DataFrame:
        # With its schema, so that a log without any event reads as an empty table.
        return self.spark.read.schema(schemas.EVENT_LOG).parquet(f"{self.path}/delivery_events_log")

    @property
    def state(self) -> DataFrame:
        return self.table("parcel_state")

    @property
    def alerts(self) -> DataFrame:
        return self.spark.read.schema(schemas.ALERTS).parquet(f"{self.path}/alerts")

    @property
    def errors(self) -> DataFrame:
        return self.spark.read.schema(schemas.DEAD_LETTERS).parquet(f"{self.path}/error_logs")

    def periods(self, name: str) -> recent.Periods | None:
        """The days, months or years that a table is partitioned by."""
        return recent.listed(self.spark, f"{self.path}/{name}")

    @property
    def hubs(self) -> DataFrame:
        return seeds.hubs(self.spark)

    @property
    def routes(self) -> DataFrame:
        return seeds.routes(self.spark)


def write_by_period(df: DataFrame, when: str, path: str, unit: str = "day", mode: str = "append") -> None:
    """Append rows partitioned by the day, month or year of the time in ``when``. Such a column is named after
    the first word of the time's name and the unit; see ``recent.dealt`` for the files.
    """
    name = f"{when.split('_')[0]}_{unit}"
    period = F.col(when).cast("date")
    if unit != "day":
        period = F.trunc(period, unit)
    recent.dealt(df.withColumn(name, period), name, unit).write.mode(mode).partitionBy(name).parquet(path)


def write_event_log(events: DataFrame, path: str, unit: str = "day", mode: str = "append") -> None:
    """Append events partitioned by the day, month or year they happened in."""
    write_by_period(events.withColumn("ingested_at", F.current_timestamp()), "event_timestamp", path, unit, mode)


def write_inputs(store: Store, planned: DataFrame, events: DataFrame, plan_order: tuple[str, ...], log_unit: str) -> None:
    """Plan and event log, which every other table follows from."""
    golden.fold_plan(planned, plan_order).write.mode("overwrite").parquet(f"{store.path}/planned_shipments")
    write_event_log(events, f"{store.path}/delivery_events_log", log_unit, mode="overwrite")


def write_state(store: Store) -> None:
    # Rows of one hub lie together inside each file, so hub filters skip row groups.
    golden.golden_record(store.plan, store.events).withColumn("updated_at", F.current_timestamp()).sortWithinPartitions(
        "hub_id", "status").write.mode("overwrite").parquet(f"{store.path}/parcel_state")


def write_exceptions(store: Store, log_unit: str) -> None:
    """Alerts and dead letters: one pass over the log finds what either table needs."""
    found = written(correlate.exceptional(store.events.drop("ingested_at"), store.plan), "exceptional")
    write_by_period(correlate.alerts_of(found.filter("known")), "created_at", f"{store.path}/alerts", log_unit, "overwrite")
    write_by_period(correlate.dead_letters_of(found.filter(~F.col("known"))), "created_at",
                    f"{store.path}/error_logs", log_unit, "overwrite")
    removed(found)


def build_store(spark: SparkSession, path: str, planned: DataFrame, events: DataFrame,
                plan_order: tuple[str, ...], log_unit: str = "day") -> Store:
    """Ingest plan and events and derive every table. Each step reads what the step before
    wrote, so no lineage is computed twice."""
    store = Store(spark, path)
    write_inputs(store, planned, events, plan_order, log_unit)
    write_state(store)
    write_exceptions(store, log_unit)
    return store


_derived: set[tuple[str, str]] = set()  # path and step


@dataclass(frozen=True)
class LazyStore(Store):
    """A store of plan and log whose other tables are derived when they are first read, once."""

    log_unit: str = "day"

    def _derive(self, step: str, write: Callable[[], None]) -> None:
        if (self.path, step) not in _derived:
            write()
            _derived.add((self.path, step))

    def table(self, name: str) -> DataFrame:
        self._need(name)
        return super().table(name)

    def _need(self, name: str) -> None:
        if name == "parcel_state":
            self._derive("state", lambda: write_state(self))
        elif name in ("alerts", "error_logs"):
            self._derive("exceptions", lambda: write_exceptions(self, self.log_unit))

    @property
    def alerts(self) -> DataFrame:
        self._need("alerts")
        return super().alerts

    @property
    def errors(self) -> DataFrame:
        self._need("error_logs")
        return super().errors

    def periods(self, name: str) -> recent.Periods | None:
        self._need(name)
        return super().periods(name)


def lazy_store(spark: SparkSession, path: str, planned: DataFrame, events: DataFrame,
               plan_order: tuple[str, ...], log_unit: str = "day") -> LazyStore:
    store = LazyStore(spark, path, log_unit)
    write_inputs(store, planned, events, plan_order, log_unit)
    return store
