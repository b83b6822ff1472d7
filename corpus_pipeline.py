"""The corpus pipeline: quality, near-duplicates, repeated passages, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again as the next one's docs. All but
the last return the columns of documents. Which stages can be told in SQL: none, so ORACLE_SQL is None and the tests hold
run() against a version in plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import byte_bpe, mixing, quality, simhash, suffix_dedup
from feedloom.llm.common import written

ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.filtered(docs, _labels(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: SimHash over five-word shingles, at the radius that stands for similarity 0.8."""
    return simhash.keep_one(docs, similar=0.8, shingle=5)


def repeat_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that also start earlier go; a character that this cuts becomes U+FFFD. No document is dropped."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    out = suffix_dedup.dedup(docs, keep=others).withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay, or repeat, at the rates that bring the domains' token totals to their targets.

    Earlier stages leave fewer poor and toxic tokens than the targets ask, so rates above 1 repeat documents. The
    classifier learns from all labelled documents, also those that earlier stages removed.
    """
    return mixing.sampled(docs, _labels(spark, sf_dir), learn=spark.read.parquet(f"{sf_dir}/documents.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), keep=("doc_id", "lang", "source"))
    return encoded.select("doc_id", "lang", "source", "n_tokens", "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", repeat_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
