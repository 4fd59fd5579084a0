"""Token counts through a cache of counts by content digest."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simplexa.llm.bpe import encoder
from simplexa.sources.shared import new_table_path

CACHE = "version string, digest binary, n_tokens long"


def version_of(path: str) -> str:
    """Digest of a tokenizer's file: counts of another build are other entries."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column) -> Column:
    """128 bits of SHA-256 of the text as the tokenizer sees it: unchanged, null as the empty text.

    Byte-level tokenizers tell all texts apart, so no further normalisation keeps counts right.
    """
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def counts_of(path: str):
    """Task function: (digest, text) to (digest, n_tokens) by whole texts."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            if path.endswith(".model"):
                import sentencepiece

                model = sentencepiece.SentencePieceProcessor(model_file=path)
                n = [len(x) for x in model.encode(texts, num_threads=1)]
            else:
                encode = encoder(path)
                n = []
                for i in range(0, len(texts), 256):
                    n += [len(x) for x in encode.ids(texts[i : i + 256])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(np.array(n, np.int64))], names=["digest", "n_tokens"])

    return run


def token_counts(documents: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 1024,
                 text: str = "text") -> DataFrame:
    """Every row with `n_bytes`, `n_tokens` and `over_limit` (n_tokens > limit).

    `cache` is a folder of Parquet files (version, digest, n_tokens), made if it is missing; None takes a new one in
    the shared folder.  Digests that it lacks are encoded once each, however many rows have them, and appended.
    A null text is an empty one (0 tokens), ids are not looked at, repeated rows stay, an empty table gives an empty
    one; columns of the three names are replaced, other columns stay.
    """
    spark = documents.sparkSession
    version = version_of(tokenizer)
    cache = cache or new_table_path(spark, "token-counts")
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    digested = documents.select(
        content_digest(F.col(text)).alias("digest"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # A copy of a text ends in the map task where another is: a hot text is shuffled once for each task.
    distinct = digested.groupBy("digest").agg(F.first("text").alias("text"))
    stored = spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version).select("digest", "n_tokens")
    misses = distinct.join(stored.select("digest"), "digest", "left_anti")
    found = misses.mapInArrow(counts_of(tokenizer), "digest binary, n_tokens long")
    found.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    counts = (
        spark.read.schema(CACHE).parquet(cache).where(F.col("version") == version)
        .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))  # two jobs may have appended the same digest
    )
    rows = documents.drop("n_bytes", "n_tokens", "over_limit").withColumns({
        "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
        "_digest": content_digest(F.col(text)),
    })
    joined = rows.join(counts.withColumnRenamed("digest", "_digest"), "_digest", "left").drop("_digest")
    return joined.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))


def token_count_table(documents: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit): texts stay behind before the join, so only digests are shuffled."""
    return token_counts(documents.select("doc_id", "text"), tokenizer).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return os.path.abspath(public_tokenizers.path(name))
