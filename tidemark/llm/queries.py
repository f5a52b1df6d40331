"""The queries of the training-data operators, for __spark_entry__.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .exact_dedup import exact_dedup
from .html_text import extract_pages
from .lm_scoring import pseudo_likelihood
from .minhash import near_duplicates
from .packing import pack_documents

from .pii import find_pii, pii_digests
from .pieces import piece_digests
from .quality import quality_scores
from .sharding import stratified_shards
from .topk import exact_top_k


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digests(find_pii(read_table(spark, sf_dir, "documents")))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op4_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards(read_table(spark, sf_dir, "documents")).drop("source", "position")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(read_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op7_masked_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(read_table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_pii, op2_quality_classifier, op3_best_fit_packing, op4_stratified_sharding, op5_exact_dedup, op6_sentencepiece, op7_masked_pseudo_likelihood, op8_exact_top_k, op9_html_extraction, op10_minhash_near_dedup)}


def oracle_sql() -> dict[str, str]:
    from . import oracles

    return {k: v for k, v in oracles.SQL.items() if k in queries()}
