"""File writers. All replace what was at the path, once the new rows are whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from terracelake.session import stored
from terracelake.sinks.swap import replaced


def write_parquet(df: DataFrame, path: str) -> None:
    with replaced(df.sparkSession, path) as (new,):
        df.write.parquet(new)


def write_partitioned(df: DataFrame, path: str, *keys: str, keep_others: bool = False,
                      gather: bool = True) -> None:
    """Parquet with one folder per value of ``keys``.

    Rows are brought together by key so that a small key becomes one file, not
    one per task; rebalancing splits a large key into several files of the
    advisory partition size, written by several tasks. ``gather=False`` saves this
    shuffle where each task has few keys already. By default the whole table is
    replaced; ``keep_others`` leaves partitions that are not in ``df`` alone, and Spark moves
    the others in when all tasks are done.
    """
    if gather:
        df = df.hint("rebalance", *keys)
    if keep_others:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    else:
        with replaced(df.sparkSession, path) as (new,):
            df.write.partitionBy(*keys).parquet(new)


def write_csv(df: DataFrame, path: str, order_by: Sequence[Column] = (), single_file: bool = True,
              hidden: Sequence[str] = ()) -> None:
    """Pipe-delimited text with a header, in the given order.

    One file, written by one task, as readers of a published result expect; what it holds
    has to fit one file's reader. ``single_file=False`` writes any number of files in
    parallel, which hold the rows in order of the files' names. ``hidden`` columns are
    there to sort by and are not written.
    """
    with replaced(df.sparkSession, path) as (new,):
        _csv(df, new, order_by, single_file, hidden)


def _csv(df: DataFrame, path: str, order_by: Sequence[Column], single_file: bool, hidden: Sequence[str]) -> None:
    if not single_file:
        df = df.orderBy(*order_by) if order_by else df
    else:
        df = df.coalesce(1)
        df = df.sortWithinPartitions(*order_by) if order_by else df
    df.drop(*hidden).write.option("header", True).option("sep", "|").csv(path)


def publish(df: DataFrame, path: str, order_by: Sequence[Column] = (), single_file: bool = True,
            hidden: Sequence[str] = ()) -> None:
    """Stores a result under ``path`` twice: as ``parquet/`` and as ``csv/``.

    The query runs once; the text is made from stored rows. ``hidden`` columns only order
    the text. Both are replaced when both are whole, so they never tell different results.
    """
    spark = df.sparkSession
    rows = stored(df, "published") if hidden else df
    with replaced(spark, f"{path}/parquet", f"{path}/csv") as (parquet, text):
        rows.drop(*hidden).write.parquet(parquet)
        if not hidden:
            rows = spark.read.schema(df.schema).parquet(parquet)
        _csv(rows, text, order_by, single_file, hidden)
