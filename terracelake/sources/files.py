"""File readers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _csv_reader(spark: SparkSession, schema: StructType | str | None, quoted_text: bool,
                options: dict[str, str]) -> DataFrameReader:
    reader = spark.read.option("header", True).option("sep", ",")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    if quoted_text:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader.options(**options)


def read_csv(spark: SparkSession, path: str | Sequence[str],
             schema: StructType | str | None = None, quoted_text: bool = False,
             **options: str) -> DataFrame:
    """Comma-separated text with a header row.

    Without a ``schema`` Spark reads all the data once more to infer it, so give
    one for large inputs. ``quoted_text`` accepts line breaks and doubled quotes
    inside quoted fields; such files are read whole by one task each, so it is not
    the default, and large inputs of this kind should come as many files.
    """
    paths = path if isinstance(path, str) else list(path)
    return _csv_reader(spark, schema, quoted_text, options).csv(paths)


def read_tagged_csv(spark: SparkSession, folder: str, names: Sequence[str], tag: str,
                    schema: StructType | str | None = None, **options: str) -> DataFrame:
    """Many CSVs of one shape as one table, with each row's name in ``tag``.

    The inputs are ``<folder>/<name>.csv``, each a file or a folder of part files; the
    tag is the name in lower case. It is one scan, and one inference, for all
    inputs rather than one for each of them.
    """
    if any(".csv" in part for part in [*names, folder.rstrip("/").rsplit("/", 1)[-1]]):
        raise ValueError("neither the names nor the folder may have .csv in them")
    rows = _csv_reader(spark, schema, False, options).csv([f"{folder}/{name}.csv" for name in names])
    # <folder>/<name>.csv or <name>.csv/<part>. The tag is made for every row, and
    # cutting the path costs a fraction of what a regular expression does.
    end = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    name = F.substring_index(F.substring_index(end, ".csv", 1), "/", -1)
    if not all(re.fullmatch(r"[\w.-]*", given, re.ASCII) for given in names):
        # The path is URL-encoded, but a plus sign in it stands for itself.
        name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return rows.withColumn(tag, F.lower(name))


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """``merge_schema`` reads the footers of all files and unites their columns."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)
