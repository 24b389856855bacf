"""Byte-level BPE (operator 4): vectorised pre-tokenisation, cached merging, decoding.

Pre-tokenisation works on arrays.  Every code point has a class; with a look at its neighbours it
becomes a symbol, and a symbol is a function on a few states.  Composition of such functions is
associative: a block is cut into rows, the functions of all rows are composed side by side, their
prefixes are combined by doubling, and a second pass over the rows reads off the state before each
code point and with it the token boundaries.  No regular expression runs on text.

Each distinct piece of a block is merged once and kept in a cache; the pieces' ids are then laid
out for all occurrences by one gather.

Defined results: a null or empty text has no tokens and decodes to nothing; texts of any length are
taken whole; ties of equal ranks merge from the left; rows of equal text give equal results; an
empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fieldpulse.llm.blocks import ENCODED_BYTES, Block, blocks, range_hashes, spread

CACHED_PIECES = 250_000
SHORT_PIECE = 48

# Classes of code points.
_LETTER, _NUMBER, _OTHER, _QUOTE, _BLANK, _WHITE = range(6)
# Symbols: classes seen with their neighbours.
_L, _N, _O, _Q, _Q2, _Q3, _JOIN, _RUN, _LONE, _END = range(10)
# States: what the last code point was part of.
_FRESH, _IN_L, _IN_N, _IN_O, _JOINING, _IN_RUN, _TWO_MORE, _ONE_MORE = range(8)
_STATES = 8


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The state after and "a token starts here", for each symbol and the state before."""
    after, begins = np.zeros((10, _STATES), np.uint8), np.ones((10, _STATES), bool)
    after[_L] = _IN_L
    after[_L, _TWO_MORE], after[_L, _ONE_MORE] = _ONE_MORE, _FRESH
    begins[_L, [_IN_L, _JOINING, _TWO_MORE, _ONE_MORE]] = False
    after[_N] = _IN_N
    begins[_N, [_IN_N, _JOINING]] = False
    for symbol, state in ((_O, _IN_O), (_Q, _IN_O), (_Q2, _ONE_MORE), (_Q3, _TWO_MORE)):
        after[symbol] = state
        after[symbol, [_IN_O, _JOINING]] = _IN_O
        begins[symbol, [_IN_O, _JOINING]] = False
    after[_JOIN] = _JOINING
    after[_RUN] = _IN_RUN
    begins[_RUN, _IN_RUN] = False
    return after, begins


_AFTER, _BEGINS = _tables()
#: The symbol of each class where the neighbours do not matter.
_ALONE = np.array([_L, _N, _O, _Q, _JOIN, _LONE], np.uint8)


@cache
def _classes() -> np.ndarray:
    """The class of every code point, from the Unicode categories and the White_Space property."""
    table = np.full(0x110000, _OTHER, np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = _LETTER
        elif kind == "N":
            table[code] = _NUMBER
        elif kind == "Z":
            table[code] = _WHITE
    table[[*range(0x09, 0x0E), 0x85]] = _WHITE
    table[0x20] = _BLANK
    table[0x27] = _QUOTE
    return table


def _symbols(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of texts that stand one after the other, an end symbol in each place of ``ends``."""
    kinds = _classes()[codes]
    symbols = _ALONE[kinds]
    white = kinds >= _BLANK
    follows = np.empty(len(codes), bool)
    follows[:-1], follows[-1] = white[1:], True
    follows[ends - 1] = True
    symbols[white & follows] = _RUN
    quotes = np.flatnonzero(kinds == _QUOTE)
    quotes = quotes[quotes + 1 < len(codes)]
    one = codes[quotes + 1]
    two = codes[np.minimum(quotes + 2, len(codes) - 1)]
    symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = _Q2
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    symbols[quotes[pair]] = _Q3
    symbols[ends] = _END
    return symbols


def _states_before(symbols: np.ndarray) -> np.ndarray:
    """The state before each symbol, by a scan over compositions of transition functions."""
    width = max(1, int(len(symbols) ** 0.5) // 8)
    rows = -(-len(symbols) // width)
    grid = np.full(rows * width, _END, np.uint8)
    grid[: len(symbols)] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    flat = _AFTER.ravel()
    whole = np.tile(np.arange(_STATES, dtype=np.uint8), (rows, 1))
    for column in grid:
        whole = flat[(column[:, None] * np.uint8(_STATES)) + whole]
    step = 1
    while step < rows:  # prefix compositions by doubling
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step].astype(np.int64), 1)
        step *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = whole[:-1, _FRESH]
    before = np.empty_like(grid)
    for i, column in enumerate(grid):
        before[i] = state
        state = flat[column * np.uint8(_STATES) + state]
    return before.T.ravel()[: len(symbols)]


def pieces_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where the pieces of a block start, and the first piece of each document."""
    if not len(block.data):
        return np.zeros(0, np.int64), np.zeros(block.size + 1, np.int64)
    codes = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.flatnonzero((block.data & 0xC0) != 0x80)
    chars = np.searchsorted(lead, block.offsets)
    gaps = chars[1:] + np.arange(block.size)  # an end symbol after each document
    placed = np.zeros(len(codes) + block.size, np.uint32)
    inside = np.ones(len(placed), bool)
    inside[gaps] = False
    placed[inside] = codes
    symbols = _symbols(placed, gaps)
    begins = _BEGINS.ravel()[symbols.astype(np.int64) * _STATES + _states_before(symbols)]
    starts = lead[begins[inside]]
    return starts, np.searchsorted(starts, block.offsets)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for a short piece, where looking at all pairs beats a heap."""
    most = len(ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i : i + 2], most) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) < most:
        i = pairs.index(least)
        parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(joined + parts[i + 1], most)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + joined, most)
    return [ranks[p] for p in parts]


def merge_ids(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent parts of lowest rank, leftmost first, until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    size = len(piece)
    if size <= SHORT_PIECE:
        return _merge_short(piece, ranks)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    end, alive = list(range(1, size + 1)), [True] * size
    heap = [
        (rank, i)
        for i in range(size - 1)
        if (rank := ranks.get(piece[i : i + 2])) is not None
    ]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i] if alive[i] else size
        if j >= size or ranks.get(piece[i : end[j]]) != rank:
            continue
        alive[j], end[i], after[i] = False, end[j], after[j]
        if after[i] < size:
            before[after[i]] = i
            if (rank := ranks.get(piece[i : end[after[i]]])) is not None:
                heapq.heappush(heap, (rank, i))
        if (left := before[i]) >= 0 and (rank := ranks.get(piece[left : end[i]])) is not None:
            heapq.heappush(heap, (rank, left))
    return [ranks[piece[i : end[i]]] for i in range(size) if alive[i]]


class PieceCache:
    """Ids of pieces as little-endian 32-bit bytes.

    Two generations: what was used since the last change and what was used before it.  When the
    younger one is full the older one goes, so frequent pieces stay and memory is bounded.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], most: int = CACHED_PIECES):
        self._encode, self._half = encode, most // 2
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        young, old = self._young, self._old
        new = []
        for piece in pieces:
            if piece not in young:
                if piece in old:
                    young[piece] = old[piece]
                else:
                    new.append(piece)
        for piece, ids in zip(new, self._encode(new) if new else []):
            young[piece] = array("I", ids).tobytes()
        found = [young[p] for p in pieces]
        if len(young) > self._half:
            self._old, self._young = young, {}
        return found


def encode_block(block: Block, known: PieceCache) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block, and where the ids of each document start."""
    starts, first = pieces_of(block)
    if not len(starts):
        return np.zeros(0, "<u4"), np.zeros(block.size + 1, np.int64)
    ends = np.append(starts[1:], len(block.data))
    _, where, which = np.unique(
        range_hashes(block.data, starts, ends), return_index=True, return_inverse=True
    )
    raw = block.data.tobytes()
    found = known([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    flat = np.frombuffer(b"".join(found), "<u4")
    lengths = sizes[which]
    ids = flat[spread((np.cumsum(sizes) - sizes)[which], lengths)]
    upto = np.append(0, np.cumsum(lengths))
    return ids, upto[first]


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Decoder:
    """Ids back to bytes; the byte offset of every token is a running sum of token lengths."""

    def __init__(self, ranks: dict[bytes, int]):
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self._lengths = np.fromiter(map(len, tokens), np.int64, size)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._data = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes, and the offset of each token in them with the total at the end."""
        lengths = self._lengths[ids]
        data = self._data[spread(self._starts[ids], lengths)]
        return data, np.append(0, np.cumsum(lengths))


def encoder(path: str) -> PieceCache:
    ranks = load_ranks(path)
    return PieceCache(lambda pieces: [merge_ids(p, ranks) for p in pieces])


def encode(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids and their byte offsets, one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, decode = encoder(path), Decoder(load_ranks(path))
        for batch in batches:
            for block in blocks(batch.column(1), ENCODED_BYTES):
                ids, first = encode_block(block, known)
                _, at = decode(ids)
                rows = [(first[i], first[i + 1]) for i in range(block.size)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array([ids[a:b].astype(np.int32) for a, b in rows], pa.list_(pa.int32())),
                        pa.array([at[a : b + 1] - at[a] for a, b in rows], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "ids", "offsets"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, ids array<int>, offsets array<long>"
    )


def round_trip(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of each document's ids and of the bytes they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, decode = encoder(path), Decoder(load_ranks(path))
        for batch in batches:
            for block in blocks(batch.column(1), ENCODED_BYTES):
                ids, first = encode_block(block, known)
                data, at = decode(ids)
                raw, plain = ids.tobytes(), data.tobytes()
                ends = first.tolist()
                cuts = at[first].tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array(np.diff(first)),
                        pa.array([hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(ends, ends[1:])]),
                        pa.array([hashlib.sha256(plain[a:b]).hexdigest() for a, b in zip(cuts, cuts[1:])]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
