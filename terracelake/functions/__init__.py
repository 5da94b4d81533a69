"""Column expressions: safe casts, numbers as text, time bounds."""

from terracelake.functions.casts import bigint_or_null, date_or_null, double_or_null
from terracelake.functions.numbers import percent_range, rounded_mean
from terracelake.functions.times import first_second, last_second

__all__ = [
    "bigint_or_null", "date_or_null", "double_or_null",
    "percent_range", "rounded_mean", "first_second", "last_second",
]
