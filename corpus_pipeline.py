"""A training corpus from raw documents, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from aeropanel.llm import decontaminate, mixing, near_dedup, repair, toxicity
from aeropanel.session import scratch_path, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the factorization machine rejects."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return near_dedup.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark."""
    return decontaminate.without_items(docs, _table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the documents of each source as often as its target weight asks for."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids to compressed shards: doc_id, start, n_tokens, ids_crc32 of every document in them."""
    return repair.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", without_toxic), ("near copies", without_copies), ("benchmark", without_benchmark), ("mixing", mixed),
    ("token ids", token_ids)]
# a trained classifier, seeded samples and a tokenizer are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), scratch_path(spark, "pipeline-" + name.replace(" ", "-")))
    return docs
