"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from simplexa.llm import decontamination, jaccard, language, packing, personal, tokens
from simplexa.llm.store import kept


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or like no learned language, go."""
    return language.in_known_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 80 % of common 5-word shingles, the one with the smallest doc_id stays."""
    return jaccard.one_of_each(docs, k=5, num=80, den=100)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which a twentieth of the words or more stands in benchmark windows."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return personal.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.packed_documents(docs, tokens.tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_free),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Hyperdimensional vectors, boosted trees and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each on the table that the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
