"""Time bounds as whole epoch seconds.

Comparing the stored integer with a constant lets both bounds reach the Parquet
scan; wrapping the column in a date function would not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def first_second(bound: str) -> Column:
    """The first whole second at or after ``bound``."""
    return F.ceil(F.unix_micros(F.to_timestamp(F.lit(bound))) / MICROS)


def last_second(bound: str) -> Column:
    """The last whole second at or before ``bound``."""
    return F.floor(F.unix_micros(F.to_timestamp(F.lit(bound))) / MICROS)
