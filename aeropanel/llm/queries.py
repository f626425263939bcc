"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.llm import (
    alignment, decontaminate, filter_audit, histogram_sort, hnsw, html_text, mixing, near_dedup, repair, suffix_dedup, token_counts,
    toxicity, warc)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_repair_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_induced_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.document_repeats(table(spark, sf_dir, "documents"))


def op4_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_copies(table(spark, sf_dir, "documents"))


def op5_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_rows(table(spark, sf_dir, "embeddings"))


def op6_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.with_main_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.document_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_sort.document_shards(table(spark, sf_dir, "documents"))


def op12_filter_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.document_alignment(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def all_queries() -> dict[str, Query]:
    found = [op1_minhash_containment, op2_repair_token_ids, op3_induced_suffixes, op4_weighted_minhash, op5_hnsw,
             op6_sainte_lague_mix, op7_text_density, op8_prefix_token_counts, op9_factorization_machine, op10_warc_revisits,
             op11_histogram_sort, op12_filter_folds, op13_token_alignment]
    return {query.__name__: query for query in found}
