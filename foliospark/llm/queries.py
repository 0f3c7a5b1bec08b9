"""Queries over the training-data operators, as ``__spark_entry__.py`` registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import decontaminate, language, licenses, merkle, minhash, ngrams, pieces, runs, suffixes, toxicity, unigram, vectors, warc


def tokenizer(name: str) -> str:
    """Where a public tokenizer file of this machine lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_read(spark, sf_dir, "documents"))


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(_read(spark, sf_dir, "pages"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), k=3, percent=85)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(_read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_read(spark, sf_dir, "embeddings"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(_read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.token_counts(_read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(_read(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.with_planted_runs(_read(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_read(spark, sf_dir, "documents"))


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.scores(_read(spark, sf_dir, "documents"))


_ALL = (
    op1_toxicity,
    op2_license_scan,
    op3_warc_derivatives,
    op4_minhash_near_dedup,
    op5_benchmark_decontamination,
    op6_sentencepiece,
    op7_embedding_near_dedup,
    op8_language_id,
    op9_token_counts,
    op10_suffix_array_dedup,
    op11_periodic_runs,
    op12_merkle_manifest,
    op13_lm_scoring,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}


def oracle_sql() -> dict[str, str]:
    """Where SQL can say the same; tests/llm holds the others against brute force or held-out rows."""
    return {"op2_license_scan": licenses.sql(), "op12_merkle_manifest": merkle.sql()}
