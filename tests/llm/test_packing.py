"""Reduction against an exhaustive packer, best fit against a plain one, pieces against the library."""

import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fieldpulse.llm import packing
from fieldpulse.llm.queries import QUERIES
from tests.conftest import SMALLEST

PATH = public_tokenizers.path("byte_bpe_50k.json")


@cache
def fewest(sizes, capacity):
    """The smallest number of sequences, by trying every set for the longest piece."""
    if not sizes:
        return 0
    head, rest = sizes[0], sizes[1:]
    best = len(sizes)

    def fill(i, room, left):
        nonlocal best
        best = min(best, 1 + fewest(tuple(left), capacity))
        for j in range(i, len(left)):
            if left[j] <= room and (j == i or left[j] != left[j - 1]):
                fill(j, room - left[j], left[:j] + left[j + 1 :])

    fill(0, capacity - head, list(rest))
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimal_packing(seed):
    pick = random.Random(seed)
    low = pick.choice([1, 3, 6, 9])
    sizes = tuple(sorted((pick.randint(low, 20) for _ in range(pick.randint(1, 8))), reverse=True))
    bins = packing._Bins(Counter(sizes), 20)
    packing.reduce_by_dominance(bins)
    rest = tuple(sorted(Counter(bins.left).elements(), reverse=True))
    assert bins.sequences + fewest(rest, 20) == fewest(sizes, 20)
    assert packing.lower_bound(Counter(sizes), 20) <= fewest(sizes, 20)


def plain_best_fit(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fits = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits)[1]] -= size
        else:
            rooms.append(capacity - size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_best_fit_equals_one_piece_at_a_time(seed):
    pick = random.Random(seed)
    sizes = [pick.randint(1, pick.choice([8, 30])) for _ in range(pick.randint(0, 120))]
    bins = packing._Bins(Counter(sizes), 30)
    packing.best_fit(bins)
    filled = Counter()
    for a in bins.assignments:
        for i in range(a.count):
            filled[a.sequence + i] += a.size
    assert sorted(30 - f for f in filled.values()) == plain_best_fit(sizes, 30)


def assert_gapless(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query(spark):
    library = Tokenizer.from_file(PATH)
    texts = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op10_packing"](spark, SMALLEST).collect()
    found = defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    for doc, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        own = sorted(found[doc], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    used = assert_gapless(rows, 1024)
    bound = packing.lower_bound(Counter(r.length for r in rows))
    assert bound <= used <= bound * 1.02 + 1


def test_ranks_of_the_library_are_those_of_the_public_file():
    ranks = packing._ranks_of(Tokenizer.from_file(PATH))
    assert ranks == packing.bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "a <|endoftext|> b", 1), (3, "same same", 1), (None, "same " * 40, 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, offset int").repartition(3)
    library = Tokenizer.from_file(PATH)
    packed = packing.pack_documents(frame, PATH, 16, with_ids=True).collect()
    assert_gapless(packed, 16)
    assert Counter(r.length for r in packed if r.doc_id in (1, 2)) == {1: 2}
    text = b"".join(r.ids for r in sorted((r for r in packed if r.doc_id is None), key=lambda r: r.piece))
    assert np.frombuffer(text, "<u4").tolist() == [*library.encode("same " * 40).ids, 2]
    special = library.encode("a <|endoftext|> b", add_special_tokens=False).ids
    assert any(np.frombuffer(r.ids, "<u4").tolist() == [*special, 2] for r in packed)
    assert packing.pack_documents(frame.limit(0), PATH).count() == 0
