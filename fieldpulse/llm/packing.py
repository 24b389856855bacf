"""Best-fit packing (operator 10): dominance reduction, then best fit.

Documents become token ids and an end id; what is longer than a sequence is cut into full
sequences and one shorter first piece.  Pieces of equal length are interchangeable, so the packing
is found on the histogram of lengths (at most ``capacity`` numbers, whatever the table): blocks of
equal sequences take runs of equal pieces.

First the reduction of Martello and Toth fixes small sets of pieces that some optimal packing
contains: for the largest open length, a single partner that fills the sequence or is at least as
long as any two others that fit together with it.  What the reduction leaves is packed best fit,
longest first.  The result of a run is a list of assignments "pieces ``first .. first + count - 1``
of length ``size`` go to sequences ``sequence ..`` at place ``offset``"; its length is bounded by the
capacity, too, so it travels to the tasks.  Each piece finds its own assignment by its rank among
the pieces of its length: partitions count their pieces per length, the counts are summed up over
the partitions before, and no length is ever gathered in one task.

Defined results: null and empty texts are one piece with the end id alone; texts of any length are
encoded whole; equal rows are packed separately; several rows with the same id are numbered each on
its own; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fieldpulse.llm import bpe
from fieldpulse.llm.blocks import ENCODED_BYTES, Block, blocks, tidied
from fieldpulse.session import work_folder

CAPACITY = 1024
END_ID = 2


# -- the packing of a histogram ----------------------------------------------------------------


@dataclass
class Assignment:
    size: int
    first: int
    count: int
    sequence: int
    offset: int


class _Bins:
    """Sequences in blocks of equal room; a piece goes where it leaves the least room."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = dict(sorted(((s, n) for s, n in histogram.items() if n), reverse=True))
        self.taken = dict.fromkeys(self.left, 0)
        self.assignments: list[Assignment] = []
        self.sequences = 0

    def place(self, size: int, count: int, sequence: int, offset: int) -> None:
        self.assignments.append(Assignment(size, self.taken[size], count, sequence, offset))
        self.taken[size] += count
        self.left[size] -= count
        if not self.left[size]:
            del self.left[size]

    def fix(self, sizes: tuple[int, ...], count: int) -> None:
        """``count`` new sequences that hold just these pieces."""
        offset = 0
        for size in sizes:
            self.place(size, count, self.sequences, offset)
            offset += size
        self.sequences += count


def reduce_by_dominance(bins: _Bins) -> None:
    """Fix sets that dominate every other way to fill the sequence of a piece, while there are any.

    For a piece, longest first, let ``room`` be what is left beside it and ``partner`` the longest
    other piece that fits.  It stays alone if nothing fits.  It goes with its partner if that fills
    the room, if no two others fit, or if no three others fit and no two that fit are longer
    together.  A step holds for as many equal pieces as there are: taking pieces away leaves the
    partner the longest, and fewer alternatives.
    """
    passed: set[int] = set()
    while (size := next((s for s in bins.left if s not in passed), None)) is not None:
        room = bins.capacity - size
        others = {s: n - (s == size) for s, n in bins.left.items() if s <= room and n > (s == size)}
        if not others:
            bins.fix((size,), bins.left[size])
            continue
        partner, least = next(iter(others)), _smallest(others, 3)
        if (
            partner == room
            or sum(least[:2]) > room
            or len(least) < 2
            or (len(least) < 3 or sum(least) > room)
            and _longest_pair(others, room) <= partner
        ):
            many = bins.left[size] // 2 if partner == size else min(bins.left[size], others[partner])
            bins.fix((size, partner), many)
        else:
            passed.add(size)


def _smallest(others: dict[int, int], many: int) -> list[int]:
    found: list[int] = []
    for size in reversed(others):
        found += [size] * min(others[size], many - len(found))
        if len(found) == many:
            break
    return found


def _longest_pair(others: dict[int, int], room: int) -> int:
    """The largest sum of two pieces that fit; 0 if none do."""
    sizes, best = list(others), 0
    for i, one in enumerate(sizes):
        for two in sizes[i:]:
            if one + two <= room and (one != two or others[one] > 1):
                best = max(best, one + two)
                break
    return best


def best_fit(bins: _Bins) -> None:
    """Longest first, each piece into the sequence where it leaves the least room.

    A sequence that has taken a piece and has room for another of that length is the tightest for
    it, so sequences of equal room take as many as fit, one sequence after the other.
    """
    by_room: dict[int, list[tuple[int, int]]] = {}  # blocks: first sequence, number of sequences

    def fill(size: int, room: int, sequence: int, count: int) -> None:
        each = room // size
        full = min(count, bins.left[size] // each)
        for many, pieces in ((full, each), (min(1, count - full), bins.left[size] - full * each)):
            pieces = min(pieces, each)
            if many and pieces:
                for i in range(pieces):
                    bins.place(size, many, sequence, bins.capacity - room + i * size)
                by_room.setdefault(room - pieces * size, []).append((sequence, many))
                sequence, count = sequence + many, count - many
        if count:
            by_room.setdefault(room, []).append((sequence, count))

    for size in list(bins.left):
        for room in sorted(r for r in by_room if r >= size):
            for block in by_room.pop(room):
                if size in bins.left:
                    fill(size, room, *block)
                else:
                    by_room.setdefault(room, []).append(block)
        if size in bins.left:
            new = -(-bins.left[size] // (bins.capacity // size))
            fill(size, bins.capacity, bins.sequences, new)
            bins.sequences += new


def pack(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Assignment], int]:
    """Assignments of all pieces, and the number of sequences."""
    bins = _Bins(histogram, capacity)
    reduce_by_dominance(bins)
    best_fit(bins)
    return bins.assignments, bins.sequences


def lower_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing needs fewer: the bound L2 of Martello and Toth."""
    best = 0
    for k in [0, *sorted(s for s in histogram if s <= capacity // 2)]:
        big = sum(n for s, n in histogram.items() if s > capacity - k)
        half = [(s, n) for s, n in histogram.items() if capacity // 2 < s <= capacity - k]
        small = sum(s * n for s, n in histogram.items() if k <= s <= capacity // 2)
        alone = sum(n for _, n in half)
        free = alone * capacity - sum(s * n for s, n in half)
        best = max(best, big + alone + max(0, -(-(small - free) // capacity)))
    return best


# -- documents to pieces, pieces to places -------------------------------------------------------


def _ranks_of(library: Tokenizer) -> dict[bytes, int] | None:
    """The merge ranks of a byte-level model if its ids are ranks: bytes first, then merges in order."""
    model = json.loads(library.to_str())["model"]
    vocabulary, merges = model["vocab"], model["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    names = sorted(vocabulary, key=vocabulary.get)[: 256 + len(pairs)]
    ordered = [a + b for a, b in pairs] == names[256:]
    if not ordered or [vocabulary[n] for n in names] != list(range(len(names))):
        return None
    # Byte-level models write the printable bytes of Latin-1 as they are, others from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(b): b for b in plain}
    signs |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return {bytes(signs[c] for c in name): rank for rank, name in enumerate(names)}


def piece_encoder(path: str) -> tuple[Tokenizer, bpe.PieceCache]:
    """The library's ids of pre-tokenised pieces; each distinct piece is encoded once.

    A model whose ids are merge ranks is applied by those ranks, which is faster for single pieces.
    """
    library = Tokenizer.from_file(path)
    ranks = _ranks_of(library)

    def encode(pieces: list[bytes]) -> list[list[int]]:
        texts = [p.decode("utf-8") for p in pieces]
        if ranks is not None:
            return [by_rank.encode_ordinary(t) for t in texts]
        return [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]

    if ranks is not None:
        by_rank = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    return library, bpe.PieceCache(encode)


def _documents_of(block: Block, library: Tokenizer, known: bpe.PieceCache, special: list[bytes]) -> list[np.ndarray]:
    """Ids of each document; texts that hold a special token's string go to the library whole."""
    ids, first = bpe.encode_block(block, known)
    rows = [ids[a:b] for a, b in zip(first.tolist(), first[1:].tolist())]
    raw = block.data.tobytes()
    if any(s in raw for s in special):
        for i in range(block.size):
            text = block.text(i)
            if any(s in text for s in special):
                whole = library.encode(text.decode("utf-8"), add_special_tokens=False)
                rows[i] = np.array(whole.ids, "<u4")
    return rows


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents: ``doc_id, piece, start, length, ids_crc32`` and ``part, nth``.

    ``nth`` numbers the pieces of equal length within the partition ``part``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        part = TaskContext.get().partitionId()
        library, known = piece_encoder(path)
        special = [t.content.encode() for t in library.get_added_tokens_decoder().values()]
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            for block in blocks(batch.column(1), ENCODED_BYTES):
                rows = []
                for i, ids in enumerate(_documents_of(block, library, known, special)):
                    total = len(ids) + 1
                    raw = ids.tobytes() + END_ID.to_bytes(4, "little")
                    head = (total - 1) % capacity + 1
                    cuts = [0, *range(head, total + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        own = raw[4 * a : 4 * b]
                        row = (docs[block.first + i], piece, a, b - a, zlib.crc32(own), part, int(seen[b - a]))
                        seen[b - a] += 1
                        rows.append((*row, own) if with_ids else row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    kinds = [id_type, pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"][: 7 + with_ids]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, nth long"
    return documents.select("doc_id", "text").mapInArrow(tidied(run), schema + ", ids binary" * with_ids)


def pack_documents(
    documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; with its ids as bytes if asked for."""
    spark = documents.sparkSession
    folder = work_folder(spark, "packing")
    pieces(documents, path, capacity, with_ids).write.parquet(folder)
    cut = spark.read.parquet(folder)
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("here"))
    histogram = counts.groupBy("length").agg(F.sum("here").alias("n")).collect()
    assignments, _ = pack({r.length: r.n for r in histogram}, capacity)
    assignments.sort(key=lambda a: (a.size, a.first))
    table = pd.DataFrame([vars(a) for a in assignments] or [], columns=["size", "first", "count", "sequence", "offset"])
    shared = spark.sparkContext.broadcast({c: table[c].to_numpy(np.int64) for c in table})
    before = F.sum("here").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(starts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = shared.value
        most = int(places["first"].max(initial=0) + places["count"].max(initial=0)) + 1
        keys = places["size"] * most + places["first"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * most + rank, side="right") - 1
            columns = [batch.column(c) for c in kept]
            columns.append(pa.array(places["sequence"][at] + rank - places["first"][at]))
            columns.append(pa.array(places["offset"][at]))
            yield pa.RecordBatch.from_arrays(columns, [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    schema = ", ".join(f"{c} {ranked.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.select(*kept, "rank").mapInArrow(run, f"{schema}, sequence_id long, offset long")
