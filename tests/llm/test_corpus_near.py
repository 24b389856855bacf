"""The near-copy stage against all pairs on five-word shingles and 80 %."""

import random

import pytest

import corpus_pipeline
from fieldpulse.llm import near_sets
from tests.conftest import SMALLEST
from tests.llm.test_near_sets import near_copies


def shingle_set(text, size):
    words = (text or "").lower().split()
    if 0 < len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def smallest_of_each(rows, size=5, percent=80):
    """The smallest document of each component, over all pairs."""
    sets = [(doc, shingle_set(text, size)) for doc, text in sorted(rows)]
    up = {doc: doc for doc, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            both = len(one & two)
            if both and 100 * both >= percent * (len(one) + len(two) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {doc for doc in up if root(doc) == doc}


def kept(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.one_of_near_copies(spark, frame, SMALLEST)
    return {r.doc_id for r in found.collect()}


@pytest.mark.parametrize("seed", range(4))
def test_stage_equals_all_pairs(spark, monkeypatch, seed):
    pick = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(near_sets, "TILE", 3)
        monkeypatch.setattr(near_sets, "ROWS_AT_ONCE", 200)
    rows = near_copies(pick, 25, pick.choice([40, 5000]))
    assert kept(spark, rows) == smallest_of_each(rows)


def test_stage_links_what_the_query_does_not(spark):
    words = [f"w{i}" for i in range(200)]
    edited = list(words)
    for at in (20, 70, 120, 170):  # one word in 50
        edited[at] = f"x{at}"
    longer = [f"l{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(longer)), (4, " ".join(longer + ["more"] + words[:14]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in near_sets.near_components(frame, 3, 90).collect()} == {1, 2, 3, 4}
    assert kept(spark, rows) == smallest_of_each(rows) == {1, 3}


def test_smallest_overlap_and_prefix_for_any_percent():
    for percent in (50, 80, 90):
        for one in range(1, 40):
            least = min(o for o in range(one + 1) if 100 * o >= percent * one)
            assert near_sets.prefix_size(one, percent) == one - least + 1
            for two in range(1, 40):
                least = min(o for o in range(200) if 100 * o >= percent * (one + two - o))
                assert near_sets.needed(one, two, percent) == least
