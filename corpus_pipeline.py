"""A training-data pipeline over ``documents``: five stages, each an operator of ``foliospark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliospark.llm import common, decontaminate, minhash, pieces, suffixes, toxicity
from foliospark.llm.queries import tokenizer


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity model rejects."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one of the smallest id, of each group of near copies (five-word shingles, 0.8)."""
    return minhash.without_near_duplicates(docs, k=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 50 words or more that an earlier document has; keeps every document."""
    return suffixes.without_repeats(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and round trip of each document that is left."""
    return pieces.encode_digests(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxic),
    ("minhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeats),
    ("benchmark decontamination", decontaminated),
    ("sentencepiece", encoded),
]

#: No stage of it can be said in SQL; tests/llm holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
