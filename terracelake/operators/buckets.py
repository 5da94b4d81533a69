"""ntile over all rows, without needing all rows in one task."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.session import stored

# monotonically_increasing_id() holds the partition above these bits and the
# row's place within the partition below them.
PLACE_BITS = 33
PLACE_MASK = (1 << PLACE_BITS) - 1


def ntile(df: DataFrame, buckets: int, order_by: Sequence[Column], alias: str = "rank",
          divide_ties: bool = False) -> DataFrame:
    """Adds the bucket number 1..``buckets`` of each row in the given order.

    A window without a partition key would put every row into one task. Here rows are dealt
    into ranges of the order, sorted and stored once; a row's place is its place in its
    range plus the rows of the ranges before. Ranges are cut at sampled bounds, and sums of
    doubles may differ in the last bit when they are computed again: stored, the rows and the
    totals are sure to be of the same ranges, whichever tasks have to run again.

    Rows that tie on the order get places next to each other in any order, and lie in one
    range. Where many may tie, ``divide_ties`` deals them to several ranges, ordered by a hash
    of all columns; ``df`` should then be a stored table, so that equal rows are told
    apart in the same way if a task runs again.
    """
    order = list(order_by)
    if divide_ties:
        hashed = [c for c, kind in df.dtypes if "map<" not in kind and kind != "variant"]
        df = df.withColumns({"_hash": F.xxhash64(*hashed), "_row": F.monotonically_increasing_id()})
        order += [F.col("_hash"), F.col("_row")]
    ranged = stored(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_hash", "_row")
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ranges",
    ).withColumn("_range", F.shiftright("_slot", PLACE_BITS))

    # One number per range, so at most one per task of the write above: small enough for the
    # driver, and for a constant in the plan. The rows then need no join.
    rows = {r["_range"]: r["n"] for r in ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = list(accumulate((rows.get(i, 0) for i in range(max(rows, default=0) + 1)), initial=0))
    small, larger = divmod(before[-1], buckets)

    # The first (total mod buckets) buckets hold one row more than the others.
    bucket = F.expr(f"""
        CASE WHEN _place < {larger * (small + 1)} THEN _place div {small + 1}
             ELSE {larger} + (_place - {larger * (small + 1)}) div {max(small, 1)}
        END + 1""")
    return (
        ranged.withColumn("_place", F.get(F.lit(before), F.col("_range").cast("int")) + F.col("_slot").bitwiseAND(PLACE_MASK))
        .withColumn(alias, bucket.cast("int"))
        .drop("_range", "_slot", "_place")
    )
