"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldpulse.llm import (
    bpe,
    fingerprint,
    language,
    language_model,
    near_sets,
    near_vectors,
    packing,
    page_text,
    phrases,
    quality,
    repeats,
    token_counts,
    vector_codes,
)
from fieldpulse.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES", "remainder_is", "table"]

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder_is(divisor: int, value: int) -> Column:
    """Whether crc32 of the document's id as text leaves ``value``; false without an id."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor
    return F.coalesce(rest == value, F.lit(False))


def op1_language_model(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return language_model.score(table(spark, folder, "documents"), remainder_is(7, 2), path)


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = table(spark, folder, "documents"), remainder_is(3, 1)
    model = language.learn(documents.where(~held_out))
    return language.identify(documents, model).withColumn("held_out", held_out)


def op3_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.edited_neighbours(table(spark, folder, "documents"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, folder, "documents"), path)


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, held_out = table(spark, folder, "documents"), remainder_is(4, 2)
    labels = table(spark, folder, "labels").where(~held_out)
    sample = quality.labelled_sample(documents.where(~held_out), labels)
    return quality.score(documents, quality.train(*sample)).withColumn("held_out", held_out)


def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.digests(table(spark, folder, "documents"))


def op7_page_text(spark: SparkSession, folder: str) -> DataFrame:
    return page_text.extract(table(spark, folder, "pages"))


def op8_near_sets(spark: SparkSession, folder: str) -> DataFrame:
    return near_sets.near_components(table(spark, folder, "documents"), shingle=3, percent=90)


def op9_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, folder, "documents"), path)


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.compress(table(spark, folder, "embeddings"))


def op13_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, folder, "documents"), path, limit=512)


QUERIES: dict[str, Query] = {
    "op1_language_model": op1_language_model,
    "op2_language": op2_language,
    "op3_fingerprint": op3_fingerprint,
    "op4_bpe": op4_bpe,
    "op5_quality": op5_quality,
    "op6_repeats": op6_repeats,
    "op7_page_text": op7_page_text,
    "op8_near_sets": op8_near_sets,
    "op9_near_vectors": op9_near_vectors,
    "op10_packing": op10_packing,
    "op11_phrases": op11_phrases,
    "op12_vector_codes": op12_vector_codes,
    "op13_token_counts": op13_token_counts,
}
