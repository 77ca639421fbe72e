"""The corpus pipeline: from documents to packed batches, in stages that are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm.common import small_batches, table
from earshot.llm.decontaminate import without_leaks
from earshot.llm.exact_dedup import keep_one
from earshot.llm.language import of_known_language
from earshot.llm.ngram_join import keep_one_per_component
from earshot.llm.queries import fresh_folder, language_model, packed


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the model knows. Rejected are null texts, texts without a letter, and texts with none of
    the n-grams that the kernels compare."""
    small_batches(spark)
    return of_known_language(docs, language_model(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose sets of five-word n-grams are 0.8 similar."""
    small_batches(spark)
    return keep_one_per_component(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch of every document that is left."""
    small_batches(spark)
    return packed(docs)


STAGES = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontaminate", decontaminated),
    ("packing", batches),
]

ORACLE_SQL = None  # kernel scores, edit distances and tokens cannot be written in SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed batches of `documents`; every stage is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
