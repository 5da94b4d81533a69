"""Casts that turn bad text into null, where ANSI mode would raise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bigint_or_null(value: Column | str) -> Column:
    return _column(value).try_cast("bigint")


def date_or_null(value: Column | str) -> Column:
    return _column(value).try_cast("date")


def double_or_null(value: Column | str) -> Column:
    return _column(value).try_cast("double")
