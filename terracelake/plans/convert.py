"""Raw CSV to processed Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from terracelake.sinks import write_parquet, write_partitioned
from terracelake.sources import read_csv, read_tagged_csv

AT_A_TIME = 4


def convert_one(spark: SparkSession, source: str, target: str,
                schema: StructType | str | None = None, quoted_text: bool = False,
                **options: str) -> None:
    """One CSV table to one Parquet table."""
    write_parquet(read_csv(spark, source, schema, quoted_text, **options), target)


def convert_many(spark: SparkSession, source_dir: str, target_dir: str, names: Sequence[str],
                 schemas: dict[str, StructType | str] | None = None, quoted_text: bool = False,
                 **options: str) -> None:
    """``<source_dir>/<name>.csv`` to ``<target_dir>/<name>/``, each on its own.

    A few conversions are under way at a time, so that small ones do not leave the
    cluster idle.
    """
    @inheritable_thread_target(spark)
    def convert(name: str) -> None:
        convert_one(spark, f"{source_dir}/{name}.csv", f"{target_dir}/{name}",
                    (schemas or {}).get(name), quoted_text, **options)

    with ThreadPoolExecutor(AT_A_TIME) as pool:
        list(pool.map(convert, names))


def convert_partitioned(spark: SparkSession, source_dir: str, target: str, names: Sequence[str],
                        tag: str, schema: StructType | str | None = None,
                        keep_others: bool = False, **options: str) -> None:
    """``<source_dir>/<name>.csv`` for all names to one Parquet table, with the
    name in lower case as the partition column ``tag``.

    A task reads parts of one input, or a few small inputs whole, so the rows lie
    together by name as they are and nothing is shuffled.
    """
    rows = read_tagged_csv(spark, source_dir, names, tag, schema, **options)
    write_partitioned(rows, target, tag, keep_others=keep_others, gather=False)
