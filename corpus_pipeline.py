"""A document table made ready for training: five stages, each one operator of ``millrace.llm`` put to use.

1. language: texts without a recognisable language go.
2. near_copies: of each group of near copies (on five words, similarity 0.8 and more) one document stays.
3. benchmark: documents that hold a passage of the benchmark go.
4. secrets: secrets in the texts are replaced by a mark; all documents stay.
5. packing: the documents become pieces of token sequences.

All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontamination, languages, near_copies, packing, secrets
from millrace.llm.texts import written
from millrace.session import apply_settings


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return languages.in_known_language(docs)


def near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_of_each(docs, size=5, percent=80)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_copies", near_copy),
    ("benchmark", benchmark),
    ("secrets", secret),
    ("packing", pack),
]

# Trained models, links and token ids are beyond SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage; what a stage returns is written and read again by the next."""
    docs = apply_settings(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
