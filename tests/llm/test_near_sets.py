"""Components against all pairs, the tree against all pairs, and odd rows."""

import random
import re

import numpy as np
import pytest

from fieldpulse.llm import near_sets
from fieldpulse.llm.graphs import components, spanning
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST


def shingle_set(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if 0 < len(words) < 3:
        return {tuple(words)}
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)}


def brute_force(rows):
    sets = [(doc, shingle_set(text)) for doc, text in rows]
    up = {doc: doc for doc, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            both = len(one & two)
            if both and 100 * both >= 90 * (len(one) + len(two) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((doc, len(one), root(doc)) for doc, one in sets)


def near_copies(pick, families, words):
    vocabulary = [f"v{i}" for i in range(words)]
    rows, doc = [], 0
    for _ in range(families):
        base = [pick.choice(vocabulary) for _ in range(pick.choice([1, 2, 5, 30, 60, 200]))]
        for _ in range(pick.randint(1, 8)):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 4])):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            if pick.random() < 0.3:
                copy += [pick.choice(vocabulary) for _ in range(pick.randint(1, 6))]
            rows.append((doc, " ".join(w.upper() if pick.random() < 0.1 else w for w in copy)))
            doc += 1
    pick.shuffle(rows)
    return [(i, text) for i, (_, text) in enumerate(rows)]


@pytest.mark.parametrize("seed", range(4))
def test_components_equal_all_pairs(spark, monkeypatch, seed):
    pick = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(near_sets, "TILE", 3)
        monkeypatch.setattr(near_sets, "ROWS_AT_ONCE", 200)
    rows = near_copies(pick, 25, pick.choice([40, 5000]))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, near_sets.near_components(frame).collect()))
    assert found == brute_force(rows)


@pytest.mark.parametrize("sides", [False, True])
def test_tree_finds_what_all_pairs_find(sides):
    pick = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        base = pick.integers(0, 1 << 62, pick.integers(25, 120)).astype(np.uint64)
        for _ in range(3):
            sets.append(np.unique(np.append(base[pick.random(len(base)) > 0.02], pick.integers(0, 99, 1).astype(np.uint64))))
    side = np.arange(len(sets)) % 2 if sides else None
    docs = list(range(len(sets)))
    first = np.cumsum([0, *map(len, sets)])
    points = near_sets.points_of(np.concatenate(sets), first)
    sizes = list(map(len, sets))
    every = [
        (i, j) for i in docs for j in docs[:i] if near_sets.linked(sets[i], sets[j]) and (not sides or side[i] != side[j])
    ]
    assert len(every) > 20
    assert sorted(near_sets.tree_links(points, sizes, docs, side, sets)) == sorted(spanning(every))
    allowed = near_sets.tree_links(points, sizes, docs, side)
    assert len(spanning(every + allowed)) == len(allowed)


def test_smallest_overlap_that_links():
    for one in range(1, 60):
        for two in range(1, 60):
            least = min(o for o in range(0, 200) if 100 * o >= 90 * (one + two - o))
            assert near_sets.needed(one, two) == least


def test_components_of_links(spark):
    pick = random.Random(7)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    frame = spark.createDataFrame(links, "a long, b long")
    expected = dict(spanning(links))
    found = {r.node: r.component for r in components(frame).collect()}
    assert {n: c for n, c in found.items() if n != c} == expected
    assert components(frame.limit(0)).count() == 0


def test_query(spark):
    documents = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op8_near_sets"](spark, SMALLEST).collect()
    assert sorted(map(tuple, rows)) == brute_force([tuple(r) for r in documents.collect()])


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (3, " \n", 0), (4, "One", 0), (5, "one", 0), (6, "one two", 0), (7, "two one", 0), (None, "one", 0), (8, "a b c d", 0), (8, "one", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, doc int").repartition(2)
    found = sorted(map(repr, map(tuple, near_sets.near_components(frame).collect())))
    expected = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (None, 1, None), (8, 2, 4), (8, 1, 4)]
    assert found == sorted(map(repr, expected))
    assert near_sets.near_components(frame.limit(0)).count() == 0
