"""The model learns from every training document, and its vocabulary is that of all of them."""

import numpy as np
import public_tokenizers

from fieldpulse.llm import language_model as lm

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = ["water", "people", "school", "music", "river", "winter", "morning", "doctor", "garden", "market"]


def id_of(word):
    return lm.load_ranks(PATH)[b" " + word.encode()]


def training(spark):
    rows = [(i, f"{word} " * 40) for i, word in enumerate(WORDS)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_vocabulary_is_of_all_training_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "START_DOCUMENTS", 1)
    monkeypatch.setattr(lm, "VOCABULARY", 20)
    model = lm.learn(training(spark), PATH, 2).model
    assert all(model.ranks[id_of(word)] >= 0 for word in WORDS)


def test_every_document_is_learned_from(spark, monkeypatch):
    monkeypatch.setattr(lm, "START_DOCUMENTS", 0)
    begun, model = lm._start(training(spark), PATH).model, lm.learn(training(spark), PATH, 2).model
    assert (begun.ranks == model.ranks).all()
    own = model.ranks[[id_of(word) for word in WORDS]]
    moved = (begun.weights["ids"] != model.weights["ids"]).any(1)
    assert (own >= 0).all() and moved[own].all()


def test_ids_are_counted_whatever_the_partitions(spark):
    one, many = (lm._id_counts(training(spark).repartition(n), PATH) for n in (1, 5))
    assert np.array_equal(one, many) and one[-1] == len(WORDS)
    assert [one[id_of(word)] for word in WORDS] == [40] * len(WORDS)
