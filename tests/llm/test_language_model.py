"""Base scores against plain counts, the model against a place-by-place one, training, odd rows."""

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from fieldpulse.llm import attention as at
from fieldpulse.llm import language_model as lm
from fieldpulse.llm.blocks import blocks
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def plain_base(rows, divisor=7, remainder=2):
    held = {doc: zlib.crc32(str(doc).encode()) % divisor == remainder for doc, _ in rows}
    counts = Counter()
    for doc, text in rows:
        if not held[doc]:
            counts.update([*words_of(text), None])
    total, distinct = sum(counts.values()), len(counts)
    found = {}
    for doc, text in rows:
        tokens = [*words_of(text), None]
        base = sum(log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        found[doc] = (held[doc], len(tokens), sum(counts[t] > 0 for t in tokens), total, base)
    return found


@pytest.fixture(scope="module")
def small_model():
    counts = np.random.default_rng(2).integers(0, 50, 700)
    return at.new_model(counts)


def plain_chance(model, history, target):
    """log10 of one target after the ranks of a window, one place at a time."""
    w = {n: x.astype(np.float64) for n, x in model.weights.items()}
    inside = w["ids"][history]
    query, key, value = inside[-1] @ w["query"], inside @ w["key"], inside @ w["value"]
    part = at.SIZE // at.HEADS
    out = []
    for h in range(at.HEADS):
        s = slice(h * part, (h + 1) * part)
        raw = key[:, s] @ query[s] / part**0.5 + w["distance"][h, np.arange(len(history))[::-1]]
        share = np.exp(raw)
        out.append(share / share.sum() @ value[:, s])
    hidden = inside[-1] + np.concatenate(out) @ w["back"]
    starts = model.starts()
    head = np.append(w["output"][: at.HEAD] @ hidden + w["bias"][: at.HEAD], w["cluster"] @ hidden + w["cluster_bias"])
    head -= np.log(np.exp(head).sum())
    if target < at.HEAD:
        return head[target] / np.log(10)
    c = int(np.searchsorted(starts, target, side="right")) - 1
    own = w["output"][starts[c] : starts[c + 1]] @ hidden + w["bias"][starts[c] : starts[c + 1]]
    return (head[at.HEAD + c] + own[target - starts[c]] - np.log(np.exp(own).sum())) / np.log(10)


def test_windows_score_each_token_once(small_model):
    pick = np.random.default_rng(3)
    texts = [pick.integers(0, 699, n) for n in (0, 1, 5, 31, 32, 33, 57, 58, 59, 200)]
    first = np.cumsum([0, *map(len, texts)])
    scores = at.score_texts(small_model, np.concatenate(texts), first)
    edge = small_model.ranks[small_model.edge]
    stride = at.WIDTH - at.CONTEXT
    for text, score in zip(texts, scores):
        ranks = [edge, *small_model.ranks[text], edge]
        total = 0
        for place in range(len(ranks) - 1):
            window = max(0, -(-(place - at.WIDTH + 1) // stride))
            total += plain_chance(small_model, ranks[window * stride : place + 1], ranks[place + 1])
        assert abs(total - score) < 1e-3 * max(1, abs(total))


def test_chances_add_up_to_one(small_model):
    hidden = np.repeat(np.random.default_rng(4).normal(size=(1, at.SIZE)), 700, 0).astype(np.float32)
    every = at.log_chances(small_model, hidden, np.arange(700))
    assert abs((10 ** every.astype(np.float64)).sum() - 1) < 1e-4


def test_gradients_equal_differences(small_model):
    model = at.Model({n: x.astype(np.float64) for n, x in small_model.weights.items()}, small_model.ranks)
    pick = np.random.default_rng(5)
    before, target = pick.integers(0, 700, (2, 9)), pick.integers(0, 700, (2, 9))
    scored = np.ones((2, 9), bool)

    def loss():
        total = 0
        for b, t in zip(before, target):
            total -= sum(plain_chance(model, b[: i + 1], t[i]) for i in range(9))
        return total * np.log(10) / at.WIDTH

    moves = {}
    trainer = at.Trainer(model)
    trainer._move = lambda name, change, rows: moves.setdefault(name, []).append((change, rows))
    trainer.step(before, target, scored)
    for name, changes in moves.items():
        full = np.zeros_like(model.weights[name])
        for change, rows in changes:
            full[rows] += change
        spot = np.unravel_index(np.abs(full).argmax(), full.shape)
        kept = model.weights[name][spot]
        model.weights[name][spot] = kept + 1e-4
        up = loss()
        model.weights[name][spot] = kept - 1e-4
        down = loss()
        model.weights[name][spot] = kept
        assert abs((up - down) / 2e-4 - full[spot]) < 1e-2 * max(1, abs(full[spot])), name


def test_training_helps_on_other_text(spark):
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    known = lm.subword_encoder(PATH)
    (learn, *_), (other, *_) = (list(blocks(pa.array(t))) for t in (texts[:500], texts[900:]))
    ids, first = lm.Text(learn).ids(known)
    counts = np.bincount(ids, minlength=lm._edge(PATH) + 1)
    model = at.new_model(counts)
    held = lm.Text(other).ids(known)
    before = at.score_texts(model, *held).sum()
    at.Trainer(model).learn(ids, first)
    assert at.score_texts(model, *held).sum() > 0.85 * before


def test_ids_that_the_model_lacks_are_spelled():
    every = lm.subword_encoder(PATH)([b"the", b"zygomorphic"])
    public = lm.load_ranks(PATH)
    names = {rank: token for token, rank in public.items()}
    ranks = np.full(lm._edge(PATH) + 1, -1)
    ranks[[public[bytes([b])] for b in range(256)]] = 0
    ranks[np.frombuffer(every[0], "<u4")] = 0
    some = [np.frombuffer(x, "<u4") for x in lm.subword_encoder(PATH, ranks)([b"the", b"zygomorphic"])]
    assert some[0].tolist() == np.frombuffer(every[0], "<u4").tolist()
    assert b"".join(names[i] for i in some[1].tolist()) == b" zygomorphic" and (ranks[some[1]] == 0).all()


def test_query(spark):
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    expected = plain_base([tuple(r) for r in documents])
    rows = QUERIES["op1_language_model"](spark, SMALLEST).collect()
    assert len(rows) == len(expected)
    for r in rows:
        held, tokens, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, tokens, known, total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
        assert r.score < 0


def test_frequent_words_are_found(spark):
    rows = [("common " * 50 + f"rare{i}",) for i in range(40)]
    learned = lm.learn(spark.createDataFrame(rows, "text string").withColumn("doc_id", lm.F.lit(1)).repartition(3), PATH, 5)
    (block,) = blocks(pa.array(["common"]))
    assert (learned.total, learned.distinct) == (2040, 41)
    found = dict(zip(*(x.tolist() for x in learned.frequent)))
    assert found[int(lm.Text(block).hashes[0])] == 2000 and len(found) == 41


def test_rare_and_frequent_words_count_alike(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * j) % 37}" for j in range(i % 11))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = plain_base(rows)
    for frequent in (1, 10**6):
        monkeypatch.setattr(lm, "FREQUENT", frequent)
        monkeypatch.setattr(lm, "ROWS_AT_ONCE", 50)
        found = lm.score(frame, lm.F.crc32(lm.F.col("doc_id").cast("string").cast("binary")) % 7 == 2, PATH).collect()
        assert len(found) == 60
        for r in found:
            assert (r.n_tokens, r.n_known) == expected[r.doc_id][1:3]
            assert abs(r.base_score - expected[r.doc_id][4]) < 1e-9


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "One one", 0), (3, "One one", 0), (None, "one two", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(2)
    none = lm.F.lit(False)
    found = sorted(((r.doc_id or 0), r.n_tokens, r.n_known) for r in lm.score(frame, none, PATH).collect())
    assert found == [(0, 3, 2), (1, 1, 1), (2, 1, 1), (3, 3, 3), (3, 3, 3)]
    assert lm.score(frame.limit(0), none, PATH).count() == 0
    untrained = lm.score(frame, lm.F.lit(True), PATH).collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in untrained} == {(0, 0, 0.0)}
