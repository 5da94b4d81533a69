"""What the operators share: stored hand-overs, worker imports, column hygiene."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracelake.session import stored as store

__all__ = ["prepare", "store", "table", "text_of"]

ROOT = str(Path(__file__).parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers that run beside the driver import this package.

    On a cluster the package is installed or shipped with ``--py-files``; the path added
    here then names nothing and is harmless.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), ROOT])
    return spark


def text_of(name: str = "text"):
    """The text, with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")
