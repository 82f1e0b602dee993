"""A training corpus from raw documents: quality, repeated lines, near-duplicates, test leaks, pieces.

Every stage works on what the one before it kept; its output is a table in the
shared folder, so a lost executor never costs more than a stage.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontaminate, linedup, minhash, pieces, quality
from shelfwise.llm.queries import PIECES
from shelfwise.staging import stage

#: Stages 1 and 4 are no SQL: a trained classifier and byte pieces.
ORACLE_SQL = None


def _in_shared_folder(spark: SparkSession) -> None:
    """Names a folder where a local session has none; on a cluster the setting is required."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty() and spark.sparkContext.master.startswith("local["):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of the labelled rows accepts."""
    _in_shared_folder(spark)
    return quality.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that occur earlier; those left without words go."""
    _in_shared_folder(spark)
    return linedup.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8."""
    _in_shared_folder(spark)
    return minhash.representatives(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    _in_shared_folder(spark)
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every remaining document."""
    _in_shared_folder(spark)
    return pieces.encode(docs, PIECES)


STAGES = [("quality", quality_filter), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("pieces", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    _in_shared_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return docs
