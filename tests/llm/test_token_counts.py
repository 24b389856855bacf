"""Token counts against the libraries, and the proof of whole tokens against plain merging."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from fieldpulse.llm import token_counts as tc
from fieldpulse.llm.blocks import blocks
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def model():
    return tc.load_merges(PATH)


@pytest.fixture(scope="module")
def whole(model):
    return tc.WholeTokens.proven(model)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def counted(texts, model, whole, block_bytes=500):
    count = tc.counter(PATH, model, whole)
    return [n for b in blocks(pa.array(texts, pa.string()), block_bytes) for n in count(b).tolist()]


def wanted(library, texts):
    return [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_merging_equals_the_library(model, library):
    pick = random.Random(5)
    for _ in range(500):
        word = "".join(pick.choice("abcdehinorst") for _ in range(pick.randint(1, 30)))
        assert model.encode(word.encode()) == library.encode(word, add_special_tokens=False).ids


def test_only_strings_that_stay_whole_are_proven(model, whole, library):
    proven = {whole.data[s : s + n].tobytes() for s, n in zip(whole.starts.tolist(), whole.sizes.tolist())}
    for i, name in model.names.items():
        if (name in proven) != (len(model.encode(name)) == 1):
            raise AssertionError((i, name))
    some = [n for n in list(proven)[:3000] if n.decode("utf-8", "ignore").encode() == n]
    assert {len(library.model.tokenize("".join(_signs_of(n)))) for n in some} == {1}


def _signs_of(name):
    back = {b: s for s, b in tc._signs().items()}
    return [back[b] for b in name]


def test_a_string_that_does_not_stay_whole_is_merged():
    """With merges ab, bc, abc = a+bc the string abc becomes ab+c: it may not be counted as one."""
    model = tc.Merges(list(range(256)), {(97, 98): (0, 300), (98, 99): (1, 301), (97, 301): (2, 302)},
                      {97: b"a", 98: b"b", 99: b"c", 300: b"ab", 301: b"bc", 302: b"abc"})
    found = tc.WholeTokens.proven(model)
    assert sorted(found.data[s : s + n].tobytes() for s, n in zip(found.starts, found.sizes)) == [
        b"a", b"ab", b"b", b"bc", b"c",
    ]
    assert model.encode(b"abc") == [300, 99]


def test_a_hash_is_not_enough(whole):
    one = whole.data[whole.starts[0] : whole.starts[0] + whole.sizes[0]]
    data = np.zeros(len(one), np.uint8)
    start, end = np.array([0]), np.array([len(one)])
    assert whole.among(one, start, end, whole.hashes[:1]).tolist() == [True]
    assert whole.among(data, start, end, whole.hashes[:1]).tolist() == [False]


def test_random_texts_equal_the_library(model, whole, library):
    pick = random.Random(3)
    signs = "abslterdvm'' \t\n  é1٣!?-日😀\x1c\x85​　Ᲊ\U000105c0"
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 3000, " " * 500, "'" * 400, "it's we'll 'S '", "", None, "x" * 90_000]
    texts += ["<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>c", "<|endoftext", "é<|endoftext|>"]
    assert counted(texts, model, whole) == wanted(library, texts)


def test_whole_table_equals_the_library(spark, library):
    found = {r.doc_id: r for r in QUERIES["op13_token_counts"](spark, SMALLEST).collect()}
    rows = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for row in rows:
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        one = found[row.doc_id]
        assert (one.n_tokens, one.n_bytes, one.over_limit) == (n, len((row.text or "").encode()), n > 512)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_count_by_their_library(spark, name):
    path = public_tokenizers.path(name)
    texts = ["Some Words here.", "", None, "日本 <|endoftext|> été"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = [r.n_tokens for r in tc.count_tokens(rows, path, 3).orderBy("doc_id").collect()]
    if name.endswith(".model"):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        assert found == [len(sp.encode(t or "")) for t in texts]
    else:
        assert found == wanted(Tokenizer.from_file(path), texts)


def test_edge_rows(spark, model, whole):
    rows = [(1, None, "x", 1), (1, "", None, 2), (None, "the the", "x", 3), (2, "the the", "y", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, count int")
    found = tc.count_tokens(frame, PATH, 1).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in found) == [
        (0, 7, 2, True), (1, 0, 0, False), (1, 0, 0, False), (2, 7, 2, True),
    ]
    assert tc.count_tokens(frame.where("false"), PATH, 1).count() == 0
    texts = spark.createDataFrame([("a", "one")], "doc_id string, text string")
    assert tc.count_tokens(texts, PATH, 1).collect()[0].doc_id == "a"
