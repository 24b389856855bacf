"""Texts are encoded once; ids tell all that texts do, and softmaxes computed together equal plain ones."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fieldpulse.llm import attention as at
from fieldpulse.llm import language_model as lm
from fieldpulse.llm.blocks import blocks
from tests.llm.test_language_model import plain_chance

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["One two", None, "", " \n\t ", "a b   c\n\nÉté  日本語 🙂", "x" * 3000 + " y", "don't stop'", "two One"]


def test_texts_are_encoded_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(i, f"word{i % 7} of many") for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").mapInArrow(counted, "doc_id long, text string")
    assert lm.score(frame, lm.F.col("doc_id") % 4 == 0, PATH).count() == 40
    # The size of all texts, which ones to start from, their texts (twice, to sort them), and the ids.
    assert read.value <= 5 * 40


def test_encoded_rows(spark):
    rows = [(i, text) for i, text in enumerate(TEXTS)]
    found = lm.encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH).orderBy("doc_id").collect()
    known = lm.subword_encoder(PATH)
    for row, text in zip(found, TEXTS):
        (block,) = blocks(pa.array([text], pa.string()))
        assert np.frombuffer(bytes(row.ids), lm._width(PATH)).tolist() == lm.Text(block).ids(known)[0].tolist()
        assert row.size == len((text or "").encode())


def test_ids_have_the_words_of_texts():
    (block,) = blocks(pa.array(TEXTS, pa.string()))
    text = lm.Text(block)
    coded = lm.Encoded(*text.ids(lm.subword_encoder(PATH)), lm.Vocabulary(PATH))
    assert np.array_equal(coded.hashes, text.hashes) and np.array_equal(coded.offsets, text.offsets)


def test_blocks_of_ids_are_those_of_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "ENCODED_BYTES", 20)
    (block,) = blocks(pa.array(TEXTS, pa.string()))
    ids, first = lm.Text(block).ids(lm.subword_encoder(PATH))
    values = [ids[a:b].astype(np.uint16).tobytes() for a, b in zip(first, first[1:])]
    batch = pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array(np.diff(block.offsets))], ["ids", "size"])
    for some in (batch, batch.slice(3)):
        skipped = batch.num_rows - some.num_rows
        found = list(lm.encoded_blocks(some, lm.Vocabulary(PATH), np.uint16))
        expected = list(blocks(pa.array(TEXTS[skipped:], pa.string()), 20))
        assert [(b.first, b.first + b.size) for b in expected] == [(own.start, own.stop) for own, _ in found]
        assert np.concatenate([text.ids for _, text in found]).tolist() == ids[first[skipped] :].tolist()


def test_missing_ids_are_spelled_as_by_the_encoder():
    (block,) = blocks(pa.array(["the zygomorphic the", "", "zygomorphic"]))
    ranks = np.full(lm._edge(PATH) + 1, -1)
    public = lm.load_ranks(PATH)
    ranks[[public[bytes([b])] for b in range(256)]] = 0
    ranks[public[b" the"]] = 0
    expected = lm.Text(block).ids(lm.subword_encoder(PATH, ranks))
    found = lm.Vocabulary(PATH, ranks).spelled(*lm.Text(block).ids(lm.subword_encoder(PATH)))
    assert all(np.array_equal(a, b) for a, b in zip(found, expected))


def test_powers_of_two():
    raw = np.append(np.linspace(-126, 126, 100_001), [0.5, -0.5, 1, 0]).astype(np.float32)
    found = at._powers(raw.copy(), at._Room())
    assert np.abs(found / 2.0 ** raw.astype(np.float64) - 1).max() < 5e-7


@pytest.fixture(scope="module")
def model():
    return at.new_model(np.random.default_rng(2).integers(0, 50, 700))


@pytest.mark.parametrize("size", [1, 40])
def test_softmaxes_computed_together(model, size):
    """With large weights too, whose logarithms are cut at 60."""
    model = at.Model({n: x * np.float32(size if n in ("output", "cluster") else 1) for n, x in model.weights.items()}, model.ranks)
    pick = np.random.default_rng(6)
    used, ranks = pick.normal(size=(300, at.SIZE)).astype(np.float32), pick.integers(0, 700, 300)
    trainer = at.Trainer(model)
    w = {n: x.astype(np.float64) for n, x in model.weights.items()}
    assert any(within is not None for *_, within in trainer._groups)
    d_used, moves = trainer._softmax(used, ranks)
    head = np.concatenate([w["output"][: at.HEAD], w["cluster"]]), np.append(w["bias"][: at.HEAD], w["cluster_bias"])
    expected, d_output, d_head = np.zeros((300, at.SIZE)), np.zeros((700, at.SIZE)), np.zeros_like(head[0])

    def error(row, vectors, bias, chosen):
        raw = np.clip(vectors @ row + bias, -60, 60)
        chance = np.exp(raw - raw.max())
        chance /= chance.sum()
        chance[chosen] -= 1
        return chance / at.WIDTH

    starts = model.starts()
    for i, (row, rank) in enumerate(zip(used.astype(np.float64), ranks)):
        c = int(np.searchsorted(starts, rank, side="right")) - 1
        e = error(row, *head, rank if c < 0 else at.HEAD + c)
        expected[i] = e @ head[0]
        d_head += np.outer(e, row)
        if c >= 0:
            own = slice(starts[c], starts[c + 1])
            e = error(row, w["output"][own], w["bias"][own], rank - starts[c])
            expected[i] += e @ w["output"][own]
            d_output[own] += np.outer(e, row)
    d_output[: at.HEAD] += d_head[: at.HEAD]
    found = np.zeros_like(d_output)
    for name, change, rows in moves:
        if name == "output":
            found[rows] += change
    assert np.abs(d_used - expected).max() < 1e-4 * max(1, np.abs(expected).max())
    assert np.abs(found - d_output).max() < 1e-4 * max(1, np.abs(d_output).max())


def test_chances_of_far_vectors(model):
    hidden = np.random.default_rng(7).normal(0, 400, (50, at.SIZE)).astype(np.float32)
    found = at.log_chances(model, hidden, np.arange(50) * 14)
    w, starts = {n: x.astype(np.float64) for n, x in model.weights.items()}, model.starts()
    head = np.concatenate([w["output"][: at.HEAD], w["cluster"]]), np.append(w["bias"][: at.HEAD], w["cluster_bias"])

    def log_share(row, vectors, bias, chosen):
        raw = vectors @ row + bias
        return raw[chosen] - raw.max() - np.log(np.exp(raw - raw.max()).sum())

    for row, rank, value in zip(hidden.astype(np.float64), np.arange(50) * 14, found):
        c = int(np.searchsorted(starts, rank, side="right")) - 1
        plain = log_share(row, *head, rank if c < 0 else at.HEAD + c)
        if c >= 0:
            own = slice(starts[c], starts[c + 1])
            plain += log_share(row, w["output"][own], w["bias"][own], rank - starts[c])
        assert abs(value - plain / np.log(10)) < 1e-3 * max(1, abs(plain))


@pytest.mark.parametrize("heads", [1, 2])
def test_heads(monkeypatch, heads):
    monkeypatch.setattr(at, "HEADS", heads)
    model = at.new_model(np.random.default_rng(2).integers(0, 50, 700))
    at.Trainer(model).learn(np.random.default_rng(8).integers(0, 699, 500), np.array([0, 180, 500]))
    ids = np.random.default_rng(9).integers(0, 699, 20)
    ranks = [model.ranks[model.edge], *model.ranks[ids], model.ranks[model.edge]]
    plain = sum(plain_chance(model, ranks[: i + 1], ranks[i + 1]) for i in range(21))
    assert abs(at.score_texts(model, ids, np.array([0, 20]))[0] - plain) < 1e-3 * abs(plain)
