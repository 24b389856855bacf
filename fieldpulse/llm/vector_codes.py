"""Vector code compression (operator 12): product codes found along a trie of distinct parts.

Components become integers ``floor(1024 * x)``, vectors are cut into equal consecutive parts, and every
part position has a codebook of at most 256 entries, improved in rounds of nearest assignment and means.

The distinct parts of the corpus, with their number as weight, are made by one aggregation and stored in
lexicographic order, so the rounds read each distinct part once and parts with common first components
stand together.  They are the leaves of a trie: a node is a prefix, and carries the distances of that
prefix from the same prefix of all entries.  A depth-first walk computes them once per node from its
parent's; at a leaf their smallest is the nearest entry.  Subtrees of few leaves are walked level by
level, so that a step works on a matrix that stays in the processor's cache.  A round sends home the
weighted sums of each entry: as many numbers as the codebooks have.  After the last round each row finds
its codes in the same way, among the distinct parts of its batch; no join brings codes back to rows, so
a part that a third of all rows share is nowhere gathered.

Defined results: vectors that are null or hold null or non-finite components are dropped, and so are
empty ones and those of another length than the vector of the smallest id; with a length that the number
of parts does not divide, zeros are added at the end; ties go to the lower entry; equal rows each count;
among equal ids the smaller vector comes first and a null id comes last; with fewer vectors than entries
the codebooks are shorter; an empty table gives no rows and empty codebooks; columns other than those
named are not read.  Integers beyond 2^28 (components beyond 2^18) raise an error, so that all sums are
exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.session import work_folder

#: Leaves of a subtree that is walked level by level.
LEAVES = 256
#: Integers of components stay below this.
BOUND = 1 << 28
#: Totals up to this many are broadcast to rows; beyond it only those that many rows need.
FEW_TOTALS = 200_000

_SHIFT = 1 << 31


# -- the trie ----------------------------------------------------------------------------------


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry (the lower one of ties) and its squared distance, for each of some parts.

    ``parts`` are distinct and in lexicographic order.
    """
    count, width = parts.shape
    index, distance = np.zeros(count, np.int64), np.zeros(count, np.int64)
    if not count:
        return index, distance
    most = max(abs(int(x)) for a in (parts, entries) for x in (a.min(), a.max()))
    kind = np.int32 if (2 * most) ** 2 * width < 1 << 31 else np.int64
    parts = parts.astype(kind)
    columns = np.ascontiguousarray(entries.T.astype(kind))  # one row per component
    # Where each part leaves the path of the one before it.
    leaves_at = np.zeros(count, np.int64)
    leaves_at[1:] = np.argmax(parts[1:] != parts[:-1], axis=1)
    open_ = [(0, count, 0, np.zeros(len(entries), kind))]
    while open_:
        low, high, depth, so_far = open_.pop()
        for start, end in _runs(low, high, leaves_at, depth):
            if end - start <= LEAVES:
                found = _walk_levels(parts, leaves_at, start, end, depth, so_far, columns)
                index[start:end] = np.argmin(found, 1)
                distance[start:end] = found[np.arange(end - start), index[start:end]]
            else:  # one child with many leaves
                step = columns[depth] - parts[start, depth]
                open_.append((start, end, depth + 1, so_far + step * step))
    return index, distance


def _runs(low: int, high: int, leaves_at: np.ndarray, depth: int) -> Iterator[tuple[int, int]]:
    """Cut the leaves of a node into runs of whole children: few leaves together, or one big child."""
    bounds = np.flatnonzero(leaves_at[low + 1 : high] == depth) + low + 1
    ends = np.append(bounds, high)
    start = low
    while start < high:
        at = int(np.searchsorted(ends, start + LEAVES, "right")) - 1
        end = int(ends[at]) if at >= 0 and ends[at] > start else int(ends[at + 1])
        yield start, end
        start = end


def _walk_levels(
    parts: np.ndarray, leaves_at: np.ndarray, low: int, high: int, depth: int, so_far: np.ndarray, columns: np.ndarray
) -> np.ndarray:
    """Distances of the leaves ``low .. high - 1`` of a node from all entries, one level after the other."""
    own = leaves_at[low:high].copy()
    own[0] = depth
    sums, heads = so_far[None], np.zeros(1, np.int64)  # of the nodes at this level: distances, first leaves
    for level in range(depth, len(columns)):
        if len(heads) < high - low:
            children = np.flatnonzero(own <= level)
            sums = sums[np.searchsorted(heads, children, "right") - 1]
            heads = children
        step = parts[low + heads, level][:, None] - columns[level]
        step *= step
        sums = sums + step if level == depth else np.add(sums, step, out=sums)
    return sums


# -- parts of vectors --------------------------------------------------------------------------


def integers(vectors: pa.Array, length: int, parts: int, scale: int) -> np.ndarray:
    """Components of a list column as integers, one row per vector, padded to whole parts."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(values * scale)
    if len(whole) and np.abs(whole).max() >= BOUND:
        raise ValueError(f"components must stay below {BOUND // scale} in size")
    rows = whole.astype(np.int64).reshape(-1, length)
    return np.pad(rows, ((0, 0), (0, -length % parts)))


def _keys(parts: np.ndarray) -> np.ndarray:
    """Parts as byte strings of one size whose order is the lexicographic order of the components."""
    coded = (parts + _SHIFT).astype(">u4")
    return np.ascontiguousarray(coded).view(f"S{4 * parts.shape[1]}").ravel()


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, which of them each row is, and how often each occurs."""
    _, where, which, often = np.unique(_keys(parts), return_index=True, return_inverse=True, return_counts=True)
    return parts[where], which.ravel(), often


def _stored(parts: np.ndarray) -> pa.Array:
    width = 4 * parts.shape[1]
    data = (parts + _SHIFT).astype(">u4").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(parts), [None, pa.py_buffer(data)]).cast(pa.binary())


def _restored(column: pa.Array, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, ">u4").astype(np.int64).reshape(-1, width) - _SHIFT


# -- codebooks ---------------------------------------------------------------------------------


@dataclass
class Codebooks:
    """``entries[part]``: the entries of a part position, one row each."""

    entries: list[np.ndarray]
    length: int
    scale: int

    @property
    def parts(self) -> int:
        return len(self.entries)

    @property
    def width(self) -> int:
        return -(-self.length // self.parts)

    def digest(self) -> str:
        """SHA-256 of all components, decimal, by part, entry and place, with commas between."""
        numbers = (str(n) for book in self.entries for n in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of integer vectors (a column per part) and the sums of their squared distances."""
        codes = np.zeros((len(rows), self.parts), np.uint8)
        errors = np.zeros(len(rows), np.int64)
        for p, book in enumerate(self.entries):
            own, which, _ = distinct_parts(rows[:, p * self.width : (p + 1) * self.width])
            index, distance = nearest(own, book)
            codes[:, p] = index[which]
            errors += distance[which]
        return codes, errors


def usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows whose vector is not null or empty and has finite components only."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & finite)


def train(
    vectors: DataFrame,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> Codebooks:
    """Codebooks that start at the vectors of smallest id and are improved over all vectors.

    The driver sees the first vectors and, in each round, one sum per entry and component.
    """
    spark = vectors.sparkSession
    kept = usable(vectors.select(id_col, vector_col), vector_col)
    smallest = kept.orderBy(F.col(id_col).asc_nulls_last(), vector_col)
    first = smallest.first()
    if first is None:
        return Codebooks([np.zeros((0, 0), np.int64)] * parts, 0, scale)
    length = len(first[1])
    kept = kept.where(F.size(vector_col) == length)
    seeds = kept.orderBy(F.col(id_col).asc_nulls_last(), vector_col).limit(entries).select(vector_col).collect()
    start = integers(pa.array([r[0] for r in seeds], pa.list_(pa.float64())), length, parts, scale)
    width = start.shape[1] // parts
    books = Codebooks([start[:, p * width : (p + 1) * width] for p in range(parts)], length, scale)
    folder = work_folder(spark, "vector_parts")
    _weighted_parts(kept.select(vector_col), books).write.parquet(folder)
    for _ in range(rounds):
        _improve(spark.read.parquet(folder), books)
    return books


def _weighted_parts(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Distinct parts of all vectors with their number, in the order of position and components."""
    length, parts, scale, width = books.length, books.parts, books.scale, books.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = integers(batch.column(0), length, parts, scale)
            for p in range(parts):
                own, _, often = distinct_parts(rows[:, p * width : (p + 1) * width])
                position = pa.array(np.full(len(own), p, np.int32))
                yield pa.RecordBatch.from_arrays([position, _stored(own), pa.array(often)], ["p", "part", "n"])

    cut = vectors.mapInArrow(run, "p int, part binary, n long")
    counted = cut.groupBy("p", "part").agg(F.sum("n").alias("n"))
    return counted.repartitionByRange("p", "part").sortWithinPartitions("p", "part")


def _improve(weighted: DataFrame, books: Codebooks) -> None:
    """One round: each entry becomes the mean (rounded down) of the parts nearest to it."""
    width = books.width
    shared = weighted.sparkSession.sparkContext.broadcast(books.entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = shared.value
        sums = [np.zeros((len(book), width + 1), np.int64) for book in entries]
        for batch in batches:
            position, often = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for p in np.unique(position).tolist():
                mine = np.flatnonzero(position == p)
                parts = _restored(batch.column(1).take(pa.array(mine)), width)
                order = np.argsort(_keys(parts), kind="stable")  # a split may join files
                parts, weight = parts[order], often[mine][order]
                index, _ = nearest(parts, entries[p])
                by_entry = np.argsort(index, kind="stable")
                index, weight = index[by_entry], weight[by_entry]
                weighed = np.column_stack([weight, parts[by_entry] * weight[:, None]])
                heads = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
                sums[p][index[heads]] += np.add.reduceat(weighed, heads, axis=0)
        for p, own in enumerate(sums):
            used = np.flatnonzero(own[:, 0])
            columns = [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32))]
            columns += [pa.array(own[used, i]) for i in range(width + 1)]
            yield pa.RecordBatch.from_arrays(columns, ["p", "entry", "n", *names])

    names = [f"s{i}" for i in range(width)]
    schema = "p int, entry int, n long, " + ", ".join(f"{n} long" for n in names)
    totals = weighted.mapInArrow(run, schema).groupBy("p", "entry").agg(*(F.sum(n).alias(n) for n in ["n", *names]))
    better = [book.copy() for book in books.entries]
    for p, entry, n, *own in totals.collect():
        better[p][entry] = [s // n for s in own]
    books.entries = better


def encode(
    vectors: DataFrame, books: Codebooks, keep: Sequence[str] = (), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``code`` (two hex digits per part) and ``error`` of every usable vector, with columns to keep."""
    named = [F.col(id_col).alias("vec_id"), *(F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep))]
    kept = usable(vectors, vector_col).where(F.size(vector_col) == books.length)
    rows = kept.select(*named, F.col(vector_col).alias("vector"))
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    passed = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            whole = integers(batch.column(len(passed)), books.length, books.parts, books.scale)
            codes, errors = books.codes(whole)
            text, size = codes.tobytes().hex(), 2 * books.parts
            names = [text[i : i + size] for i in range(0, len(text), size)]
            columns = [batch.column(i) for i in range(len(passed))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(errors)], [*passed, "code", "error"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    coded = rows.mapInArrow(run, f"{kinds}, code string, error long")
    return coded.withColumnsRenamed({f"kept_{i}": c for i, c in enumerate(keep)})


def decode(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id`` and the vector that a code stands for, in the scale of the input."""
    shared = codes.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for batch in batches:
            index = np.frombuffer(bytes.fromhex("".join(batch.column(1).to_pylist())), np.uint8).reshape(-1, books.parts)
            rows = np.hstack([book[index[:, p]] for p, book in enumerate(books.entries)])[:, : books.length]
            vectors = pa.array(list(rows / books.scale), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], ["vec_id", "vector"])

    kind = codes.schema["vec_id"].dataType.simpleString()
    return codes.select("vec_id", "code").mapInArrow(run, f"vec_id {kind}, vector array<double>")


def with_total(rows: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """``rows`` (a stored table) with the sum of ``value`` over rows of equal ``by``, nulls together.

    Few totals are broadcast.  Of many, those that more than a thousandth of all rows need (at most a
    thousand) are, and only rows of the others are shuffled, so no task gathers a frequent value.
    """
    totals = rows.groupBy(F.col(by).alias("_by")).agg(F.sum(value).alias(name), F.count(F.lit(1)).alias("_n"))

    def joined(some: DataFrame, sums: DataFrame) -> DataFrame:
        return some.join(sums.drop("_n"), some[by].eqNullSafe(F.col("_by"))).drop("_by")

    if totals.limit(FEW_TOTALS + 1).count() <= FEW_TOTALS:
        return joined(rows, F.broadcast(totals))
    frequent = totals.where(F.col("_n") > rows.count() // 1000)
    wanted = F.broadcast(frequent.select("_by"))
    others = rows.join(wanted, rows[by].eqNullSafe(F.col("_by")), "left_anti")
    return joined(rows, F.broadcast(frequent)).unionByName(joined(others, totals))


def compress(
    vectors: DataFrame, label_col: str = "label", id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Codes of all usable vectors with their error, the error of their label, and the codebooks' digest."""
    spark = vectors.sparkSession
    books = train(vectors, id_col=id_col, vector_col=vector_col)
    folder = work_folder(spark, "vector_codes")
    encode(vectors, books, (label_col,), id_col, vector_col).write.parquet(folder)
    coded = spark.read.parquet(folder)
    found = with_total(coded, label_col, "error", "label_error").withColumn("codebooks_sha256", F.lit(books.digest()))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
