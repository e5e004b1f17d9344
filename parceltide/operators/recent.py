"""Newest-first pages of tables that are partitioned by a period of their time column.

A page of the latest rows needs the newest periods only, but how many depends on the filter. So the
newest period is looked at first and the range is widened until it holds the page; a look stops at
``limit`` rows. The rows that are left are cut by a partition filter, whatever ranks them afterwards.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

WIDEN = 4  # times as many periods a look


class Periods(NamedTuple):
    """The partition column of a table and its values, newest first."""

    column: str
    newest_first: list[date]


def listed(spark: SparkSession, path: str) -> Periods | None:
    """The periods of a table from the names of its folders; None if it has no such folders."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []
    found = [n.split("=", 1) for n in names if "=" in n]
    if not found:
        return None
    days = [date.fromisoformat(value) for _, value in found if value[:1].isdigit()]
    return Periods(found[0][0], sorted(days, reverse=True))


def dealt(rows: DataFrame, column: str, unit: str) -> DataFrame:
    """``rows`` as they should be written partitioned by ``column``, their day, month or year.

    The rebalance hint lets AQE size the files: small partitions are merged and a period that holds most of the
    rows is written by several tasks. Years are few, so every task writes a file of each and nothing is shuffled.
    """
    return rows if unit == "year" else rows.hint("rebalance", column)


def newest(rows: DataFrame, periods: Periods | None, limit: int | None) -> DataFrame:
    """``rows`` of the newest periods that hold ``limit`` of them, and rows without a time, which rank first."""
    if periods is None or limit is None:
        return rows
    column, taken = F.col(periods.column), 1
    while taken < len(periods.newest_first):
        since = F.lit(periods.newest_first[taken - 1])
        some = rows.filter(column.isNull() | (column >= since))
        if some.limit(limit).count() >= limit:
            return some
        taken *= WIDEN
    return rows
