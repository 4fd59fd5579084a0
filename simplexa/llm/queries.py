"""One query for each operator over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from simplexa.llm import (
    collocations,
    decontamination,
    divergence,
    fingerprints,
    jaccard,
    language,
    licenses,
    packing,
    personal,
    repeats,
    sharding,
    tokens,
    urls,
)

TOKENIZER = "byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Eight shards of near-equal bytes."""
    return sharding.shard_table(documents(spark, folder), leaves=8)


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all texts through a digest cache."""
    return tokens.token_count_table(documents(spark, folder), tokens.tokenizer_path(TOKENIZER))


@query
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return packing.packed_documents(documents(spark, folder), tokens.tokenizer_path(TOKENIZER), limit=1024, end=2)


@query
def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Order MinHash of all texts and of their edits."""
    return fingerprints.fingerprint_table(documents(spark, folder))


@query
def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of texts that share 90 % of their 3-word shingles."""
    return jaccard.jaccard_components(documents(spark, folder), k=3, num=90, den=100)


@query
def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontamination.benchmark_hits(
        documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), window=13, share=20)
    return found.drop("spans", "items")


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 words or more that several texts have."""
    return repeats.repeated_spans(documents(spark, folder))


@query
def op8_license_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Known licences that a text or one of its lines is."""
    return licenses.license_scan(documents(spark, folder), licenses.known_licenses(spark))


@query
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all texts."""
    return personal.personal_data(documents(spark, folder))


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted languages of all texts."""
    return language.predicted_languages(documents(spark, folder))


@query
def op11_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Rules on all page URLs."""
    return urls.judged(spark.read.parquet(f"{folder}/pages.parquet"), urls.rule_table(spark))


@query
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of a language differ in their terms."""
    return divergence.source_divergence(documents(spark, folder))


@query
def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases of two and three words that stand together."""
    return collocations.collocations(documents(spark, folder))


ORACLE: dict[str, str] = {
    "op8_license_digests": licenses.scan_sql(),
    "op11_url_cascade": urls.judged_sql(),
    "op12_source_divergence": divergence.divergence_sql(),
    "op13_collocations": collocations.collocations_sql(),
}
