"""Texts of Arrow batches as flat byte arrays, their words, and 64-bit hashes of byte ranges.

All tasks of this package read texts in blocks of whole documents of about ``BLOCK_BYTES``, so the
memory of a task does not depend on the size of its partition (a longer document is a block of
its own).
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
#: For encoders, which look up each distinct word of a block once.
ENCODED_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_C = ctypes.CDLL(None)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


@dataclass
class Block:
    """Documents ``first .. first + len(offsets) - 1`` of a batch: their UTF-8 bytes in one array."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks of whole documents; a null text is an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    if texts.null_count or not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string()).fill_null("")
    _, ends, content = texts.buffers()
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    for at, to in cuts_of(offsets, most):
        low = int(offsets[at])
        yield Block(at, data[low : int(offsets[to])], offsets[at : to + 1] - low)


def cuts_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First document of each block, and the first one after it, given where the documents start.

    Afterwards freed memory is given back.
    """
    at = 0
    while at < len(offsets) - 1:
        to = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
        to = min(max(to, at + 1), len(offsets) - 1)
        yield at, to
        at = to
    _give_back()


def _give_back() -> None:
    """Return freed memory to the system; Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task that returns freed memory when it has ended, and not only after its blocks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return task


def values_of(column: pa.Array) -> Iterator[memoryview]:
    """The binary values of a column that are not null, one at a time; parts of them are no copies."""
    return (memoryview(x.as_buffer()) for x in column if x.is_valid)


def that_fit(sizes: Iterable[int], most: int) -> list[bool]:
    """Which of some texts fit into ``most`` together, in turn; one that does not is skipped."""
    fits = []
    for size in sizes:
        fits.append(size <= most)
        most -= size if fits[-1] else 0
    return fits


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers_up_to(size: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < size:
        size = -(-size // 65_536) * 65_536
        up, down = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


#: What the length of a byte range adds to its hash.
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def range_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each byte range, from which ``joined_hashes`` makes the hashes of ranges joined."""
    up, down = _powers_up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range; equal bytes have equal hashes wherever they stand."""
    return mixed(range_values(data, starts, ends) + (ends - starts).astype(np.uint64) * _LENGTH)


def joined_hashes(values: np.ndarray, sizes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``range_hashes`` of what parts ``starts[i] .. ends[i] - 1`` are joined, from their values and bytes."""
    at = np.append(0, np.cumsum(sizes))
    up, down = _powers_up_to(int(at[-1]) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[at[:-1]], out=sums[1:])
    lengths = (at[ends] - at[starts]).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * down[at[starts]] + lengths * _LENGTH)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return _LOWER[data]


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+``: byte ranges, and the first word of each document."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[first]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[last] = inside[last]
    at = np.flatnonzero(starts)
    return Words(at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all ranges one after the other: ``starts[i] .. starts[i] + lengths[i] - 1``."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each element of the ranges given by ``offsets``, the number of its range."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
