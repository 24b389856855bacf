"""Bounded samples leave out documents that do not fit, and no others."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from fieldpulse.llm import language_model as lm
from fieldpulse.llm import quality

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def with_a_long_first(spark):
    """Twelve documents of which the first one in hash order is over the bounds below."""
    ids = spark.range(12).withColumnRenamed("id", "doc_id")
    first = ids.orderBy(F.xxhash64("doc_id")).first().doc_id
    many = F.when(F.col("doc_id") == first, 1000).otherwise(5)
    return first, ids.withColumn("text", F.expr("'river garden '")).withColumn("text", F.repeat("text", many))


def test_quality_goes_on_after_a_long_document(spark, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_CHARS", 1000)
    first, docs = with_a_long_first(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"))
    texts, marks = quality.labelled_sample(docs, labels)
    assert len(texts) == len(marks) == 11 and max(map(len, texts)) == 65
    assert sum(marks) == 6 - first % 2
    # Equal rows are counted one by one.
    texts, _ = quality.labelled_sample(docs.unionAll(docs), labels)
    assert len(texts) == 15


def test_the_start_goes_on_after_a_long_document(spark, monkeypatch):
    monkeypatch.setattr(lm, "START_CHARS", 1000)
    _, docs = with_a_long_first(spark)
    some = lm._start(docs, PATH).model.weights["ids"]
    monkeypatch.setattr(lm, "START_DOCUMENTS", 0)
    assert not np.array_equal(some, lm._start(docs, PATH).model.weights["ids"])
