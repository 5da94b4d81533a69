"""How often each item was sold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.config import NOT_FOR_SALE
from terracelake.operators import not_like_any


def order(item: str = "item") -> list[Column]:
    return [F.col("count").desc(), F.col(item).asc()]


def build(sales: DataFrame, item: str = "item",
          excluded: Sequence[str] = NOT_FOR_SALE) -> DataFrame:
    """Count per item, most sold first.

    This is a cube over one column whose total row, like the group of unnamed
    items, has a null item and so never passes the filter. What is left of the cube
    is a plain grouping, and the filter can run in the scan.
    """
    return (
        sales.filter(not_like_any(item, excluded))
        .groupBy(item).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(*order(item))
    )
