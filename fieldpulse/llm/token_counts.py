"""Token counts (operator 13): whole tokens counted at sight, only the rest merged.

Before any text is read, each string of the vocabulary is encoded alone.  Those that end as one
token, their own, are proven whole: a pre-token equal to one of them is one token, whatever text it
stands in, since pre-tokens are encoded separately.  Not every string of a vocabulary is whole: an
earlier merge may take one of its bytes away.

Texts are cut into pre-tokens on arrays.  Each pre-token's 64-bit hash is looked up among those of the
whole strings, and a hit is compared byte by byte, so no collision counts.  What is left is merged, each
distinct pre-token of a block once and the frequent ones of a task once altogether.

The shortcut holds for byte-level BPE without normaliser.  A text goes to the library whole if it has the
string of an added token, which the library cuts out first, or a code point that Python's Unicode tables
do not know; so do all texts of other tokenizers (``.json``) and of sentencepiece (``.model``).

Defined results: a null or empty text has no bytes and no tokens; texts of any length are counted whole;
rows of equal text give equal results; repeated ids stay separate rows; an empty table gives no rows;
columns other than id and text are not read.
"""

from __future__ import annotations

import heapq
import json
import sys
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import ENCODED_BYTES, Block, blocks, owners, range_hashes, spread
from fieldpulse.llm.bpe import PieceCache, pieces_of

Pairs = dict[tuple[int, int], tuple[int, int]]


# -- the model and the proof -------------------------------------------------------------------


@dataclass
class Merges:
    """A byte-level BPE model: ids of the bytes, and for two adjacent ids their rank and joint id."""

    of_byte: list[int]
    pairs: Pairs
    names: dict[int, bytes] = field(repr=False)

    def encode(self, piece: bytes) -> list[int]:
        """Join the adjacent ids of lowest rank, leftmost first, until none can be joined."""
        ids = [self.of_byte[b] for b in piece]
        size, pairs = len(ids), self.pairs
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(known[0], i) for i in range(size - 1) if (known := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= size or (known := pairs.get((ids[i], ids[j]))) is None or known[0] != rank:
                continue
            ids[i], ids[j], after[i] = known[1], -1, after[j]
            if after[i] < size:
                before[after[i]] = i
                if next_ := pairs.get((ids[i], ids[after[i]])):
                    heapq.heappush(heap, (next_[0], i))
            if (left := before[i]) >= 0 and (next_ := pairs.get((ids[left], ids[i]))):
                heapq.heappush(heap, (next_[0], left))
        return [i for i in ids if i >= 0]


def _signs() -> dict[str, int]:
    """How byte-level models write bytes: printable ones of Latin-1 as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_merges(path: str) -> Merges | None:
    """The model of a tokenizers file if the shortcut holds for it, else None."""
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    model, cut = whole["model"], whole["pre_tokenizer"] or {}
    odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")
    if (
        model["type"] != "BPE"
        or any(model.get(k) for k in odd)
        or whole["normalizer"]
        or cut.get("type") != "ByteLevel"
        or cut.get("add_prefix_space")
        or not cut.get("use_regex")
        or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in whole["added_tokens"])
    ):
        return None
    signs, ids = _signs(), model["vocab"]
    pairs: Pairs = {}
    for rank, pair in enumerate(model["merges"]):
        one, two = pair.split(" ") if isinstance(pair, str) else pair
        pairs[ids[one], ids[two]] = rank, ids[one + two]
    added = {t["id"] for t in whole["added_tokens"]}
    names = {i: bytes(signs[c] for c in s) for s, i in ids.items() if i not in added and set(s) <= signs.keys()}
    return Merges([ids[s] for s, _ in sorted(signs.items(), key=lambda x: x[1])], pairs, names)


@dataclass
class WholeTokens:
    """The strings proven to be one token: sorted hashes, and where their bytes lie."""

    hashes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @classmethod
    def proven(cls, model: Merges) -> WholeTokens:
        strings = [name for i, name in model.names.items() if model.encode(name) == [i]]
        data = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        starts = np.cumsum(sizes) - sizes
        hashes = range_hashes(data, starts, starts + sizes)
        order = np.argsort(hashes)
        return cls(hashes[order], starts[order], sizes[order], data)

    def among(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which of the byte ranges equal one of the strings."""
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        hit = np.flatnonzero((self.hashes[at] == hashes) & (self.sizes[at] == ends - starts))
        sizes = self.sizes[at[hit]]
        unlike = data[spread(starts[hit], sizes)] != self.data[spread(self.starts[at[hit]], sizes)]
        found = np.zeros(len(starts), bool)
        found[hit] = True
        if unlike.any():
            found[hit[np.unique(np.repeat(np.arange(len(hit)), sizes)[unlike])]] = False
        return found


@cache
def _unknown_codes() -> np.ndarray:
    """Code points without a category here; a library with newer tables may cut around them otherwise."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])


# -- counting ----------------------------------------------------------------------------------


@dataclass
class Counter:
    """Counts the tokens of the documents of a block."""

    whole: WholeTokens
    rest: PieceCache
    added: list[bytes]
    library: Callable[[list[str]], list[int]]

    def __call__(self, block: Block) -> np.ndarray:
        starts, first = pieces_of(block)
        counts = np.diff(first)
        if len(starts):
            ends = np.append(starts[1:], len(block.data))
            hashes = range_hashes(block.data, starts, ends)
            rest = np.flatnonzero(~self.whole.among(block.data, starts, ends, hashes))
            _, where, which = np.unique(hashes[rest], return_index=True, return_inverse=True)
            raw = block.data.tobytes()
            distinct = rest[where]
            found = self.rest([raw[a:b] for a, b in zip(starts[distinct].tolist(), ends[distinct].tolist())])
            more = np.fromiter((len(ids) // 4 - 1 for ids in found), np.int64, len(found))[which]
            document = owners(first)[rest]
            counts = counts + np.bincount(document, more, block.size).astype(np.int64)
        for i in self._left_to_library(block):
            counts[i] = self.library([block.text(i).decode("utf-8")])[0]
        return counts

    def _left_to_library(self, block: Block) -> list[int]:
        raw, odd = block.data.tobytes(), set()
        for mark in self.added:
            at = raw.find(mark)
            while at >= 0:
                odd.add(int(np.searchsorted(block.offsets, at, "right")) - 1)
                at = raw.find(mark, at + 1)
        if (block.data > 0x7F).any():
            lead = np.flatnonzero((block.data & 0xC0) != 0x80)
            codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
            unknown = lead[_unknown_codes()[codes]]
            odd.update((np.searchsorted(block.offsets, unknown, "right") - 1).tolist())
        return sorted(i for i in odd if any(m in block.text(i) for m in self.added) or not block.text(i).isascii())


def library_counter(path: str) -> tuple[Callable[[list[str]], list[int]], list[bytes]]:
    """Counts by the library of the file, and the strings of its added tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)], []
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    added = [t.content.encode() for t in library.get_added_tokens_decoder().values()]
    return lambda texts: [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)], added


def counter(path: str, model: Merges | None, whole: WholeTokens | None) -> Callable[[Block], np.ndarray]:
    library, added = library_counter(path)
    if model is None:
        return lambda b: np.array(library([b.text(i).decode("utf-8") for i in range(b.size)]), np.int64)
    return Counter(whole, PieceCache(lambda pieces: [model.encode(p) for p in pieces]), added, library)


def count_tokens(documents: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than ``limit`` tokens.

    The model and the proven strings, of the size of the vocabulary, travel with the tasks.
    """
    model = load_merges(path) if path.endswith(".json") else None
    proven = WholeTokens.proven(model) if model else None
    shared = documents.sparkSession.sparkContext.broadcast((model, proven))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, *shared.value)
        for batch in batches:
            for block in blocks(batch.column(1), ENCODED_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array(np.diff(block.offsets)),
                        pa.array(count(block).astype(np.int64)),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    kind = documents.schema[id_col].dataType.simpleString()
    counted = documents.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
