"""The training-data pipeline: quality classifier, near copies, benchmark passages, secrets, mixing.

Each stage takes what the one before kept and returns the columns of
documents; the last returns the mixed corpus in training order, a row for each
copy that is taken, with epoch and position.

Defined results: rows with null texts or ids go through every stage like any
other (quality scores a null text as an empty one; a row without an id stays
only where its group has no other; null texts stay null); repeated rows become one at
the near copies; empty tables give empty tables; further columns are carried,
also where their names are those of an operator's own columns, but for epoch
and position, which the mixture sets; n_chars follows the text.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import byte_cnn, fm_decontam, mixing, secret_ledger, simhash_pivots
from souk.llm.common import documents
from souk.plans.pipeline import delete_path
from souk.session import checkpoint_dir


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network scores below one half go; it learns from all labels of ids in the given rows."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return byte_cnn.accept(docs, byte_cnn.train(docs, labels))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash_pivots.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside occurrences of benchmark windows are cut out."""
    return _counted(fm_decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark."""
    return _counted(secret_ledger.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies that the sources' targets take, range-sorted by training position."""
    return mixing.training_order(docs)


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark_passages", benchmark_passages), ("secrets", secrets), ("mixture", mixture)]
#: SQL can't express the network, the fingerprints and the index; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written, and the next reads it from there.

    A stage's rows go when the next one's are written; the last written ones stay for the reader of the result.
    """
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            delete_path(spark, f"{folder}/{before}")
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
