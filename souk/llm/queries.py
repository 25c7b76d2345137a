"""The operators' queries, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.llm import (
    ball_tree, bin_completion, byte_cnn, fm_decontam, host_rules, lm_scoring, mixing, secret_ledger, simhash_pivots, suffix_dedup, token_align, toxicity,
    window_dedup,
)
from souk.llm.common import crc_mod, cut, documents


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.by_position(mixing.assign(documents(spark, sf_dir)))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.remove_repeats(documents(spark, sf_dir)))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return lm_scoring.score(docs, lm_scoring.training_rows(docs))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf_dir))


def op5_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.report(window_dedup.remove_repeats(documents(spark, sf_dir)))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.report(toxicity.score(docs, toxicity.train(docs, labels, keep=toxicity.training_rows(labels))))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the versions (by id) go into a written ledger first; all are then looked up in it, and only what it lacks is scanned."""
    docs = documents(spark, sf_dir)
    ledger = cut(secret_ledger.as_ledger(secret_ledger.scan(docs.where(crc_mod(docs.doc_id, 2) == 0))))
    return secret_ledger.report(secret_ledger.findings(docs, ledger))


def op8_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    return byte_cnn.report(byte_cnn.score(docs, byte_cnn.train(docs, labels, keep=byte_cnn.training_rows(labels))))


def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_pivots.report(simhash_pivots.groups(documents(spark, sf_dir)))


def op10_fm_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return fm_decontam.report(fm_decontam.contamination(documents(spark, sf_dir), items))


def op11_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return bin_completion.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op13_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_align.align(documents(spark, sf_dir), (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")))


QUERIES = {f.__name__: f for f in (
    op1_mixing, op2_suffix_dedup, op3_lm_scoring, op4_host_rules, op5_window_dedup, op6_toxicity, op7_secret_ledger, op8_byte_cnn, op9_simhash_pivots, op10_fm_decontam,
    op11_ball_tree, op12_bin_completion, op13_token_align)}
SQL: dict[str, str] = {"op1_mixing": mixing.SQL, "op4_host_rules": host_rules.SQL, "op7_secret_ledger": secret_ledger.SQL, "op10_fm_decontam": fm_decontam.SQL, "op11_ball_tree": ball_tree.SQL}
