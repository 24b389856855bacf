"""Repeats against a search over all windows, and odd rows."""

import hashlib
import random
import re

import pytest

from fieldpulse.llm import repeats
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_force(documents, window):
    """Kept words by document, comparing every window with all that start earlier."""
    seen, kept = set(), {}
    for doc, text in sorted(documents):
        words, gone = words_of(text), set()
        for start in range(len(words) - window + 1):
            content = tuple(words[start : start + window])
            if content in seen:
                gone.update(range(start, start + window))
            seen.add(content)
        kept[doc] = ([w for i, w in enumerate(words) if i not in gone], len(words))
    return kept


def assert_equals_brute_force(rows, documents, window):
    expected = brute_force(documents, window)
    assert len(rows) == len(expected)
    for r in rows:
        words, total = expected[r.doc_id]
        assert (r.n_words, r.n_removed) == (total, total - len(words)), r.doc_id
        assert r.kept_sha256 == hashlib.sha256(" ".join(words).encode()).hexdigest()


@pytest.mark.parametrize("seed", range(6))
def test_random_texts(spark, monkeypatch, seed):
    """Few different words, long runs and periods, passages shared within and between texts."""
    pick = random.Random(seed)
    monkeypatch.setattr(repeats, "KEYS_AT_ONCE", pick.choice([50, 10**6]))
    vocabulary = [f"w{i}" for i in range(pick.choice([2, 5, 60]))]
    passages = [[pick.choice(vocabulary) for _ in range(pick.randint(5, 60))] for _ in range(8)]
    passages += [["x"] * pick.randint(1, 70), ["x", "y"] * pick.randint(1, 40), ["a", "a", "b"] * 20]
    documents = []
    for doc in range(60):
        words = []
        for _ in range(pick.randint(0, 6)):
            words += pick.choice(passages) if pick.random() < 0.6 else [f"n{doc}_{pick.random()}" for _ in range(9)]
        documents.append((doc, pick.choice([" ", "\n", " \t"]).join(words)))
    documents += [(100 + i, documents[i][1]) for i in range(10)]
    frame = spark.createDataFrame(documents, "doc_id long, text string").repartition(4)
    window = pick.choice([20, 8])
    assert_equals_brute_force(repeats.digests(frame, window).collect(), documents, window)


def test_query(spark):
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op6_repeats"](spark, SMALLEST).collect()
    assert_equals_brute_force(rows, [tuple(r) for r in documents.collect()], 20)
    assert sum(r.n_removed for r in rows) > 0


def test_texts_keep_their_columns(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, "Start\n" + passage, "x", 3), (2, passage + "\tend", None, 4), (3, None, "y", 5), (4, "a\nb", "", 6)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, starts string, doc int")
    found = repeats.without_repeats(frame)
    assert found.columns == frame.columns
    expected = [(1, "Start\n" + passage, "x", 3), (2, "end", None, 4), (3, None, "y", 5), (4, "a\nb", "", 6)]
    assert sorted(map(tuple, found.collect())) == expected


def test_odd_rows(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    rows = [(None, passage), (1, None), (2, ""), (3, passage), (3, passage), (4, "short text"), (5, passage), (5, "x " + passage)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted((repr(r.doc_id), r.n_words, r.n_removed) for r in repeats.digests(frame).collect())
    assert found == [
        ("1", 0, 0), ("2", 0, 0), ("3", 25, 0), ("3", 25, 0), ("4", 2, 0), ("5", 25, 25), ("5", 26, 25), ("None", 25, 25),
    ]
    assert repeats.digests(frame.limit(0)).count() == 0
