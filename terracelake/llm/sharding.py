"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """Puts all rows, in the order of doc_id, into shards 0 to ``shards`` - 1 of nearly equal bytes.

    A row's size is its text in UTF-8 bytes plus ``overhead``. One row each: doc_id, size,
    text_crc32, ``first_byte`` (bytes of all rows before it), shard, slot (its place in the
    shard, from 0).

    Rows are dealt into ranges of doc_id and stored without their texts. The ranges' totals
    are summed up in order, one row per range, and each row adds what stands before it in
    its own range. A row goes to the shard in which its middle byte lies, so cuts are within
    one row of the equal targets and equal texts may be in different shards.

    A null text has no bytes. Rows without doc_id come first. Rows with the same doc_id are
    ordered by size and checksum, and equal rows lie side by side in any order. An empty
    table gives no rows. Other columns are not read.
    """
    prepare(docs.sparkSession)
    order = ["doc_id", "size", "text_crc32", "tie"]
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
        # Divides rows that are equal otherwise, however many, between ranges.
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"))
    ranged = store(
        store(sized, "sizes").repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges")

    running = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    starts = store(totals.select(  # one row per range
        "range",
        F.coalesce(F.sum("bytes").over(running), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(running), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(Window.orderBy("range").rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing)).alias("all_bytes")), "starts")

    own = Window.partitionBy("range").orderBy(*order)
    placed = store(
        ranged.withColumns({
            "before": F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
            "nth": F.row_number().over(own) - 1,
        })
        .join(F.broadcast(starts), "range")
        .withColumn("first_byte", F.col("before") + F.col("bytes_before"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
            f"CAST(floor((first_byte + size / 2) * {shards} / all_bytes) AS INT)")))
        .select("doc_id", "size", "text_crc32", "first_byte", "shard",
                (F.col("nth") + F.col("rows_before")).alias("place")),
        "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "first_byte", "shard", (F.col("place") - F.col("first")).alias("slot"))
