"""The registered queries of this subpackage: one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import (
    byte_repeats, conversations, decontamination, embeddings, languages, lexical, mixing, near_copies, oracles, packing, passages, secrets, token_counts, toxicity,
)
from millrace.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return apply_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents")).drop("kept")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages.identify(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.repeated_bytes(table(spark, sf_dir, "documents")).drop("kept")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_links(table(spark, sf_dir, "embeddings"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"))


def op11_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(conversations.damaged(table(spark, sf_dir, "conversations")))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    name: query for name, query in list(globals().items()) if name.startswith("op") and name[2].isdigit()
}
SQL: dict[str, str] = {"op12_conversation_repair": oracles.CONVERSATION_REPAIR, "op13_ranked_search": oracles.RANKED_SEARCH}
