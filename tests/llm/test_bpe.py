"""The encoder against the tiktoken library, and exact round trips."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from fieldpulse.llm import bpe
from fieldpulse.llm.blocks import blocks
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={}
    )


def encoded(texts, block_bytes=500):
    known, rows = bpe.encoder(PATH), []
    decode = bpe.Decoder(bpe.load_ranks(PATH))
    for block in blocks(pa.array(texts, pa.string()), block_bytes):
        ids, first = bpe.encode_block(block, known)
        data, at = decode(ids)
        assert data.tobytes() == block.data.tobytes() and at[-1] == len(data)
        rows += [ids[first[i] : first[i + 1]].tolist() for i in range(block.size)]
    return rows


def test_random_texts_equal_the_library(reference):
    pick = random.Random(3)
    signs = "abslterdvm'' \t\n  é1٣!?-日😀\x1c\x85​　"
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 500, "'" * 400, "it's we'll 'S '", "<|endoftext|>", "", None]
    assert encoded(texts) == [reference.encode_ordinary(t or "") for t in texts]


def test_every_class_of_code_points(reference):
    codes = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = ["x{0}{0} 1{0} !{0}".format(chr(c)) for c in codes]
    assert encoded(texts, 100_000) == reference.encode_ordinary_batch(texts)


def test_a_full_cache_is_emptied(reference):
    known = bpe.PieceCache(lambda ps: [bpe.merge_ids(p, bpe.load_ranks(PATH)) for p in ps], most=3)
    for text in ("one two three four five", "one six one"):
        (block,) = blocks(pa.array([text]))
        assert bpe.encode_block(block, known)[0].tolist() == reference.encode_ordinary(text)


def test_edge_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, "same", None), (3, "same", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = {(r.doc_id, tuple(r.ids)): r.offsets for r in bpe.encode(frame, PATH).collect()}
    assert found[1, ()] == [0] and found[2, ()] == [0] and len(found) == 4
    assert bpe.round_trip(frame, PATH).count() == 5
    assert bpe.round_trip(frame.limit(0), PATH).count() == 0


def test_query(spark, reference):
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    texts = dict(documents.select("doc_id", F.coalesce("text", F.lit(""))).collect())
    rows = QUERIES["op4_bpe"](spark, SMALLEST).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = np.array(reference.encode_ordinary(texts[r.doc_id]), "<u4")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
