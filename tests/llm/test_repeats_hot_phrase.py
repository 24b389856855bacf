"""A phrase that very many otherwise different documents share gives no false repeats."""

import numpy as np

from fieldpulse.llm import repeats


def test_different_windows_around_a_hot_phrase_stay_apart():
    many, size, window = 150_000, 32, 20
    pick = np.random.default_rng(1)
    words = pick.integers(1, 1 << 63, (many, size), dtype=np.uint64)
    words[:, 12:20] = pick.integers(1, 1 << 63, 8, dtype=np.uint64)
    key, at, first, count, hashes = repeats.keys_of(words.ravel(), np.arange(many + 1) * size, window)
    entries = np.zeros(len(key), repeats._ENTRY)
    entries["key"], entries["many"], entries["doc"] = key, count, first // size
    entries["at"], entries["first"] = at - first // size * size, first % size
    assert np.unique(key, return_counts=True)[1].max() > 50_000
    assert hashes.dtype == np.uint64
    unpacked, unpacked_hashes = repeats._unpacked(repeats._packed(entries, hashes))
    assert not repeats.repeats(unpacked, unpacked_hashes).any()
    # The same passage in two documents is still found.
    assert repeats.repeats(np.append(entries, entries[:1]), np.append(hashes, hashes[: count[0]])).sum() == 0
    twin = entries[:1].copy()
    twin["doc"] = many
    assert repeats.repeats(np.append(entries, twin), np.append(hashes, hashes[: count[0]])).sum() == count[0]
