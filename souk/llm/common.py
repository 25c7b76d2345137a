"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder once; later uses read it, also after an executor is lost."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the measure for hash ranges, set with the input's size."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ranges(docs: DataFrame, text_col: str, size: int) -> int:
    """Hash ranges for an operator that holds one in a task: of about ``size`` bytes of text, whatever the session's shuffle partitions."""
    total = docs.agg(F.sum(F.octet_length(docs[text_col]).cast("long"))).first()[0] or 0
    return max(partitions(docs.sparkSession), -(-total // size))


def give_back() -> None:
    """Freed memory that Arrow and the C library keep goes back to the system: a Python worker that is used again doesn't add it to its next task's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pick(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; others can't clash."""
    return docs.select(*[docs[c].alias(k) for k, c in columns.items()])


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m
