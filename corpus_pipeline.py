"""A training corpus out of raw documents, in stages that each write a table and read it again.

Toxic documents go, one document of each group of near-duplicates stays,
documents that overlap with a benchmark go, personal data is replaced, and what
is left becomes token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.llm import bpe, decontaminate, pii, simhash, toxicity
from clearbook.sources.staging import stage, staged_until_done

SHINGLE, RADIUS = 3, 2  # words, differing bits


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_harmless(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, SHINGLE, RADIUS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without personal data; ``n_chars`` follows them."""
    return pii.redacted(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in place of the text, their number, and the digest of what they decode to."""
    table = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoded = bpe.encode(docs, table, public_tokenizers.PATTERN, decoded_column="decoded")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("byte_bpe", to_tokens),
]

# Trained models and a vocabulary decide; the tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def write(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write what ``run`` returns to ``path`` (parquet); all that was staged on the way is deleted then."""
    with staged_until_done(spark):
        run(spark, sf_dir).write.mode("overwrite").parquet(path)
