"""Measure columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio_measures(num: Column, den: Column) -> Column:
    """Ratio of two aggregates as double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def margin(revenue: Column, cost: Column) -> Column:
    """Revenue minus cost, NULL when either is NULL."""
    return (revenue - cost).cast("decimal(12,2)")


def change(value: Column, previous: Column) -> Column:
    """Relative change as double, NULL without a usable previous value."""
    return F.try_divide((value - previous).cast("double"), previous.cast("double"))
