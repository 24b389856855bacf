"""Held-out accuracy, features against a plain count, and odd rows."""

import re
import zlib

import numpy as np
import pyarrow as pa

from fieldpulse.llm import quality
from fieldpulse.llm.blocks import blocks, range_hashes
from fieldpulse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def test_features_are_those_of_a_plain_count():
    texts = ["Ab abc abcd abc abc", "", "x\ty", "éab"]
    (block,) = blocks(pa.array(texts))
    _, of = quality.features_of(block)
    for i, text in enumerate(texts):
        words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        grams = sum(max(0, len(w) - n + 1) for w in words for n in quality.GRAM_SIZES)
        assert (of == i).sum() == len(words) + max(0, len(words) - 1) + grams


def test_hashes_depend_on_bytes_alone():
    data = np.frombuffer(b"abcXabcYabd", np.uint8)
    a, b, c = range_hashes(data, np.array([0, 4, 8]), np.array([3, 7, 11]))
    assert a == b != c


def test_held_out_accuracy(spark):
    labels = dict(spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality").collect())
    rows = QUERIES["op5_quality"](spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.95


def test_odd_rows(spark):
    documents = spark.createDataFrame(
        [(1, "good words here", 5), (2, "bad bad bad", 5), (3, None, 5), (4, "", 5), (None, "good", 5)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame(
        [(1, 1), (1, None), (2, 0), (2, 1), (9, 1), (None, 1)], "doc_id long, quality int"
    )
    texts, marks = quality.labelled_sample(documents, labels)
    assert sorted(zip(texts, marks)) == [("bad bad bad", 0), ("good words here", 1)]
    model = quality.train(texts, marks)
    rows = {r.doc_id: r.score for r in quality.score(documents, model).collect()}
    assert rows[1] > rows[2] and rows[3] == rows[4] and len(rows) == 5
    assert quality.score(documents.limit(0), model).count() == 0
    unknown = quality.train(*quality.labelled_sample(documents, labels.limit(0)))
    assert {r.score for r in quality.score(documents, unknown).collect()} == {0.5}
