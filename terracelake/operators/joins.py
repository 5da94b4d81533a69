"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import mul

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.functions import bigint_or_null
from terracelake.operators.unions import union_all
from terracelake.session import stored


def join_to_unique(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join of ``many`` to ``one``, which has one narrow row per key.

    ``one`` is stored first. Spark then knows its true size and broadcasts it if that is under
    its threshold. Otherwise the join has a plain shuffle on both sides, and adaptive
    execution can split a partition that a hot key has made large; it cannot do so
    where one side is the output of an aggregate.
    """
    return many.join(stored(one, "unique"), key, how)


def safe_key_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  how: str = "inner") -> DataFrame:
    """Equi-join of a key that may be text with an integer key.

    Text that is not a number matches nothing, and raises nothing. An inner join
    drops it before the shuffle. In a left join the null keys meet in one partition, which
    adaptive execution splits; it can't where the next step groups by the cast key itself,
    since that needs the join's partitioning, so group by the text key there.
    """
    key = bigint_or_null(left[left_key])
    if how == "inner":
        left = left.filter(key.isNotNull())
    return left.join(right, key == right[right_key], how)


def fanout_counts(base: DataFrame, key: str, **sides: tuple[DataFrame, str]) -> DataFrame:
    """How many rows ``base`` has after left joins to all ``sides`` on one key.

    The rows of each side ``name=(df, column)`` are counted per key, all sides in one
    shuffle, and the counts are multiplied: the joined rows are never built. Adds
    ``<name>_rows`` (0 where there is no match) and ``joined_rows`` to ``base``.
    """
    if not sides:
        raise ValueError("fanout_counts needs at least one side")
    names = [f"{name}_rows" for name in sides]
    keys = [
        side.filter(F.col(column).isNotNull()).select(
            F.col(column).alias(key), *(F.lit(int(name == own)).alias(name) for name in names))
        for own, (side, column) in zip(names, sides.values())
    ]
    counted = union_all(keys).groupBy(key).agg(*(F.sum(name).alias(name) for name in names))
    joined = join_to_unique(base, counted, key, "left").fillna(0, names)
    return joined.withColumn(
        "joined_rows", reduce(mul, (F.greatest(F.col(name), F.lit(1)) for name in names)))
