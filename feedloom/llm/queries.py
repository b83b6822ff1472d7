"""The queries of this subpackage's operators over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm import byte_bpe, class_lm, html_text, media, mixing, quality, simhash, suffix_dedup, token_counts, topk

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.scores(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), digests=True)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_suffix_dedup, op2_html_text, op3_class_lm, op4_token_counts, op5_mixing, op6_exact_topk, op7_simhash, op8_quality, op9_byte_bpe, op10_media)}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_topk": """
with rows as (
  select vec_id, [floor(256 * x::double) for x in embedding] as v from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scores as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from rows q join rows c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as n from scores
)
select query_id, n::int as rank, vec_id, score from ranked where n <= 5""",
    }
