"""Rounding, guarded division and order-independent sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, places: int) -> Column:
    """Round on the scaled binary value, as the warehouse's ``round`` does.

    Spark's own ``round(double, n)`` rounds the decimal text, so 1.005 becomes
    1.01; scaling first gives 1.0, which is what stored marts contain.
    """
    scale = float(10**places)
    return F.round(value * F.lit(scale)) / F.lit(scale)


def round2(value: Column) -> Column:
    return round_to(value, 2)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null, not an error, for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def pct(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * F.lit(100)


def exact_sum(value: Column, places: int = 6) -> Column:
    """Sum through decimals: the result does not depend on task order, so a
    retried or re-planned stage gives the same number."""
    return F.sum(value.cast(f"decimal(28,{places})")).cast("double")
