"""Aggregate expressions shared by the store queries."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on a decimal, as the store's ``numeric`` does, then widen."""
    return F.round(value.cast("decimal(38,15)"), digits).cast("double")


def average(value: Column, digits: int = 1) -> Column:
    return round_half_up(F.avg(value), digits)


def percentage(hits: Column, total: Column, digits: int = 1) -> Column:
    """``100 * hits / total`` rounded; NULL when there is nothing to divide by."""
    share = F.lit(100).cast("decimal(5,1)") * hits / F.nullif(total, F.lit(0))
    return F.round(share, digits).cast("double")


def round_double(value: Column, digits: int) -> Column:
    """Correct rounding of a double to decimal places, ties to even.

    ``value * 10**digits`` is itself rounded; where it lands exactly between two integers, the
    sign of the product's rounding error tells on which side the true product lies.
    """
    scale = 10.0**digits
    product = value * scale
    spread = value * 134217729.0  # 2**27 + 1 splits a double into two exact halves
    high = spread - (spread - value)
    error = (high * scale - product) + (value - high) * scale
    tie = product - F.floor(product) == 0.5
    nearest = (
        F.when(tie & (error > 0), F.ceil(product).cast("double"))
        .when(tie & (error < 0), F.floor(product).cast("double"))
        .otherwise(F.rint(product))
    )
    return nearest / scale
