"""Grouped counts that shrink their input before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cube_count(df: DataFrame, *columns: str) -> DataFrame:
    """Row count for every grouping set of ``columns``, in a column ``count``.

    A cube expands each input row once per grouping set. Counting the finest
    groups first means that only those groups are expanded, not the raw rows.
    """
    finest = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    return finest.cube(*columns).agg(F.sum("count").alias("count"))
