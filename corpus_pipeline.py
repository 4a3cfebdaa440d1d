"""A training-data pipeline: stages over ``documents``, each written and read again by the next.

Language ID drops what it rejects, SimHash keeps one document of each group of near
duplicates, decontamination drops documents with benchmark windows, the secret scan
blanks secrets, and mixing emits the documents at the target weights of their sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, mixing, secret_scan, simhash
from tidemark.llm.common import read
from tidemark.llm.queries import language_model
from tidemark.session import materialize


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; the model learns from this stage's input."""
    return language.keep_identified(docs, language_model(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emit(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", blank_secrets),
    ("mixing", mix_sources),
]
# The trained language model is beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
