"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracelake.llm.common import store, table
from terracelake.llm.decontaminate import without_items
from terracelake.llm.line_dedup import drop_shared_lines
from terracelake.llm.packing import pack
from terracelake.llm.quality import judge
from terracelake.llm.simhash import representatives


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents judged toxic or low-grade go."""
    return judge(docs, table(spark, sf_dir, "labels")).filter("keep").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds go; n_chars follows the text."""
    return drop_shared_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by fingerprints of four-word runs, at most four bits apart, the one with the smallest doc_id stays."""
    return representatives(docs, shingle=4, distance=4).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_items(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

# A trained classifier, fingerprints and tokens are beyond SQL: tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
