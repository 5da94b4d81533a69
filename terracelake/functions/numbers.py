"""Arithmetic that yields null, not an error, on an empty or zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_range(high: Column, low: Column, close: Column) -> Column:
    """The day's range as a percentage of the closing price."""
    return F.try_divide(high - low, close) * 100


def rounded_mean(total: Column, count: Column, digits: int) -> Column:
    """``total / count`` rounded half up; null where nothing was counted."""
    return F.round(F.try_divide(total, count), digits)
