"""A corpus from raw documents to training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's ``docs``.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import language, near_sets, packing, quality, repeats
from fieldpulse.llm.queries import remainder_is
from fieldpulse.session import work_folder

#: Words a shingle, and the percentage of shared shingles, that make near copies in a corpus.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    sample = quality.labelled_sample(docs.where(~remainder_is(4, 2)), labels.where(~remainder_is(4, 2)))
    return quality.accepted(docs, quality.train(*sample))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that are in none of the languages learned."""
    return language.accepted(docs, language.learn(docs.where(~remainder_is(3, 1))))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near copies."""
    return near_sets.representatives(docs, NEAR_SHINGLE, NEAR_PERCENT)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without passages that earlier text has; ``n_chars`` follows the text."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("language", known_language),
    ("near_copies", one_of_near_copies),
    ("repeats", without_repeats),
    ("packing", sequences),
]

#: SQL can express neither the learned models nor the tokenizer; the tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}_{name}")
        docs = spark.read.parquet(f"{folder}/{number}_{name}")
    return docs
