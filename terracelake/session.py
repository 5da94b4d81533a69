"""Session factory, and the shared folder for lineage cuts and scratch tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# The results depend on these, so they are set whatever the cluster says.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Only used where neither spark-submit nor the cluster gives a value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A side of a join is broadcast up to this size: of its files times the factor, which
    # stands for what Parquet saves, or of its rows where adaptive execution has seen them.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str, master: str | None = None, hive: bool = False,
                **conf: str) -> SparkSession:
    """Start, or join, a session.

    ``hive=True`` keeps the catalog in the configured Hive-compatible metastore;
    otherwise the catalog lives as long as the session.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()
    for key, value in DEFAULTS.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    for key, value in {**SEMANTICS, **conf}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A machine-local temporary folder is only ever used by a local master.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = _local_dir()
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


@cache
def _local_dir() -> str:
    """One folder for the life of this process, whose sessions are local."""
    path = tempfile.mkdtemp(prefix="terracelake-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{_scratch(spark)}/{uuid.uuid4().hex}/{name}"


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Computes ``df`` once, into Parquet in the shared folder, written with ``options``.

    Later steps read the same rows however often they run, also after executors are lost;
    they read only the columns they need, and Spark knows the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this application has stored on the way; DataFrames that read it end here."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
