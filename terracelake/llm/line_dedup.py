"""Removes lines that many documents share."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of

# Blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = " \t\n\x0b\x0c\r"


def drop_shared_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drops every line that at least ``min_docs`` documents hold, but not from the one with the smallest doc_id.

    Lines are compared without white space at their ends and with A-Z lower-cased; those
    of fewer than ``min_chars`` code points then are always kept. All columns are kept,
    ``text`` without the dropped lines; ``n_lines`` and ``n_dropped`` are added, or
    replaced where the table has such columns.

    Lines are exploded and known by a 128-bit hash. Documents are counted per hash with
    partial sums, so a line in a third of all documents is a few rows per task. The join
    that tells each line whether it goes has a stored table on both sides: adaptive
    execution can split a hash that most rows share. Only the positions of dropped lines
    go back to the documents.

    A null text is one empty line and stays null. Rows with the same doc_id are one
    document: none of them loses a line to another. Rows without doc_id are one document
    that comes after all others. Rows that are equal get equal results. An empty table
    gives no rows.
    """
    prepare(docs.sparkSession)
    keyed = docs.withColumns({
        "_ld_id": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)),
        "_ld_print": F.xxhash64(text_of()),
    })
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    lines = store(
        keyed.select("_ld_id", "_ld_print", F.posexplode(F.split(F.translate(text_of(), upper, lower), "\n"))
                     .alias("_ld_line", "key"))
        .withColumn("key", F.btrim("key", F.lit(SPACE)))
        .filter(F.length("key") >= min_chars)
        .select("_ld_id", "_ld_print", "_ld_line", F.xxhash64("key").alias("h1"),
                F.xxhash64(F.lit("second"), "key").alias("h2")),
        "lines")
    shared = store(
        lines.groupBy("h1", "h2", "_ld_id").agg(F.lit(1).alias("n"))
        .groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("_ld_id").alias("keeper"))
        .filter(F.col("n") >= min_docs).select("h1", "h2", "keeper"),
        "shared_lines")
    dropped = (
        lines.join(shared, ["h1", "h2"]).filter("_ld_id <> keeper")
        .groupBy("_ld_id", "_ld_print").agg(F.sort_array(F.collect_set("_ld_line")).alias("_ld_dropped"))
    )
    # The kept lines are the stretches between dropped ones.
    kept = F.expr(r"""
        array_join(flatten(transform(sequence(0, size(_ld_dropped)), i -> slice(
            _ld_lines,
            if(i = 0, 0, element_at(_ld_dropped, if(i = 0, 1, i)) + 1) + 1,
            if(i = size(_ld_dropped), size(_ld_lines), element_at(_ld_dropped, least(i + 1, size(_ld_dropped))))
              - if(i = 0, 0, element_at(_ld_dropped, if(i = 0, 1, i)) + 1)))), '\n')""")
    return (
        keyed.join(store(dropped, "dropped_lines"), ["_ld_id", "_ld_print"], "left")
        .withColumn("_ld_lines", F.split(text_of(), "\n"))
        .withColumns({
            "text": F.when(F.col("_ld_dropped").isNull(), F.col("text")).otherwise(kept),
            "n_lines": F.size("_ld_lines").cast("long"),
            "n_dropped": F.coalesce(F.size("_ld_dropped"), F.lit(0)).cast("long"),
        })
        .drop("_ld_id", "_ld_print", "_ld_dropped", "_ld_lines")
    )
