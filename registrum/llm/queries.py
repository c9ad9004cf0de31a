"""The queries opN_<name>: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, hmm_lm, matroska, mixing, near_dedup, oracles, quality_fm, separator_scan, sharding, suffix_dedup, token_store


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.pareto_mix(documents(spark, sf_dir), odds=mixing.by_length).select("doc_id", "size", "source_size", "target", "taken")


def op2_tiered_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_placement(documents(spark, sf_dir))


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_ids(documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"), end_id=2)


def op5_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matroska.features(matroska.to_media(documents(spark, sf_dir)))


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The separator 50256 is free in this vocabulary, so no text has it."""
    import public_tokenizers

    return separator_scan.count_tokens(documents(spark, sf_dir), tokenizer("byte_bpe_multi_50k.tiktoken"), pattern=public_tokenizers.PATTERN, separator=50256)


def op3_hmm_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_lm.score_documents(documents(spark, sf_dir))


def op6_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), shingle=2, percent=80).drop("row")


def op8_column_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.dedup(documents(spark, sf_dir), window=100))


def op9_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES = {f.__name__: f for f in (op1_pareto_mix, op2_tiered_sharding, op3_hmm_language_model, op4_token_store, op5_matroska, op6_tensored_minhash, op7_separator_scan, op8_column_suffix_dedup, op9_quality_fm, op10_spaced_seeds)}
ORACLES = {"op1_pareto_mix": oracles.OP1, "op6_tensored_minhash": oracles.OP6, "op8_column_suffix_dedup": oracles.OP8}
