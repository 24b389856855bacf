"""LM scoring (operator 1): a causal self-attention model over subword ids, and exact word counts.

Words are lower-cased and written as public byte-level BPE ids, a leading space first; the model of
:mod:`fieldpulse.llm.attention` gives the probability of the ids of a text and its end.  It has the
``VOCABULARY`` most frequent ids of all training texts, and others are spelled in bytes.
Training:

* one pass that encodes every text; ids are kept, two or four bytes each, and what follows reads them;
* a count of the ids of all training texts, for the vocabulary;
* a start on the driver, ``START_PASSES`` over at most ``START_DOCUMENTS`` whole training texts chosen
  by a hash (a documented bound);
* one pass over all training texts on the executors: every task goes on from the start with all
  its documents, and the tasks' weights are averaged by the number of places they learned from, in
  rounds of ``FAN_IN``, so neither a task nor the driver ever holds more than that many models.

The last pass counts words.  Words that make up more than one in ``FREQUENT`` of all words (so at
most that many, a bound that does not grow) travel to the scoring tasks.  All other words are sent,
packed, to the task that owns their hash, which counts them in the training texts and sends each
row's part of its base score on; a second exchange adds up the rows.  Texts are never shuffled.

Defined results: null and empty texts consist of their end alone; texts of any length are scored
whole, the document being the unit of memory; rows without an id are neither held out nor trained
on; equal rows are scored each, with equal results; without any training text all counts are 0 and
the model is untrained; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm import attention
from fieldpulse.llm.blocks import (
    ENCODED_BYTES,
    Block,
    blocks,
    cuts_of,
    joined_hashes,
    lowered,
    mixed,
    owners,
    range_hashes,
    range_values,
    spread,
    that_fit,
    tidied,
    words_of,
)
from fieldpulse.llm.bpe import PieceCache, load_ranks
from fieldpulse.llm.exchange import targets_for
from fieldpulse.session import work_folder

START_DOCUMENTS = 2_000
START_CHARS = 5_000_000
START_PASSES = 3
VOCABULARY = 8_192
FAN_IN = 16
FREQUENT = 500_000
ROWS_AT_ONCE = 1_000_000
CACHED_WORDS = 600_000
_COUNT = np.dtype([("word", "<u8"), ("n", "<u4")])
_ENTRY = np.dtype([("word", "<u8"), ("row", "<i8"), ("times", "<u4"), ("trained", "<u4")])
_PART = np.dtype([("row", "<i8"), ("known", "<i8"), ("base", "<f8")])


# -- texts to words and ids --------------------------------------------------------------------------


def subword_encoder(path: str, ranks: np.ndarray | None = None) -> PieceCache:
    """Ids of words by the public ranks, without a pattern that splits words first.

    Ids that a model's ``ranks`` do not have are spelled byte by byte.
    """
    public = load_ranks(path)
    # Words have no line ends, so a text of a word a line is encoded in one go.
    lines = tiktoken.Encoding("words", pat_str=r"\n| [^\n]*", mergeable_ranks=public, special_tokens={})
    end = public[b"\n"]
    missing = set() if ranks is None else set(np.flatnonzero(ranks < 0).tolist())

    def spelled(ids: list[int]) -> list[int]:
        if missing.isdisjoint(ids):
            return ids
        parts = ([public[bytes([b])] for b in lines.decode_single_token_bytes(i)] if i in missing else [i] for i in ids)
        return [j for own in parts for j in own]

    def encode(words: list[bytes]) -> list[list[int]]:
        ids = lines.encode_to_numpy((b" " + b"\n ".join(words) + b"\n").decode("utf-8"))
        ends = np.flatnonzero(ids == end).tolist()
        every = ids.tolist()
        found = [every[a:b] for a, b in zip([0, *(e + 1 for e in ends)], ends)]
        return list(map(spelled, found)) if missing else found

    return PieceCache(encode, CACHED_WORDS)


def _edge(path: str) -> int:
    return max(load_ranks(path).values()) + 1


class Text:
    """Words of a block: their hashes, the first word of each document, and on demand their ids."""

    def __init__(self, block: Block):
        self._data = lowered(block.data)
        words = words_of(self._data, block.offsets)
        self._words, self.offsets, self.size = words, words.offsets, block.size
        self.hashes = range_hashes(self._data, words.starts, words.ends)

    def ids(self, known: PieceCache) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, and the first id of each."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(self.size + 1, np.int64)
        _, at, which = np.unique(self.hashes, return_index=True, return_inverse=True)
        raw, words = self._data.tobytes(), self._words
        found = known([raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
        lengths = sizes[which]
        upto = np.append(0, np.cumsum(lengths))
        return flat[spread((np.cumsum(sizes) - sizes)[which], lengths)], upto[self.offsets]


def _width(path: str) -> type:
    return np.uint16 if _edge(path) <= 1 << 16 else np.uint32


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """``documents`` with the ids of the public ranks in place of their ``text``, and its bytes as ``size``."""
    others, width = [c for c in documents.columns if c != "text"], _width(path)
    names = [*others, "ids", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = subword_encoder(path)
        for batch in batches:
            for block in blocks(batch.column(len(others)), ENCODED_BYTES):
                own = slice(block.first, block.first + block.size)
                ids, first = Text(block).ids(known)
                ends = first * width().itemsize
                if ends[-1] > np.iinfo(np.int32).max:
                    raise ValueError(f"a text of {len(ids)} subwords is too long for one value")
                ends = pa.py_buffer(ends.astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), block.size, [None, ends, pa.py_buffer(ids.astype(width))])
                size = pa.array(np.diff(block.offsets))
                yield pa.RecordBatch.from_arrays([*(batch.column(i)[own] for i in range(len(others))), packed, size], names)

    kinds = [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in others]
    return documents.select(*others, "text").mapInArrow(tidied(run), ", ".join([*kinds, "ids binary", "size long"]))


class Vocabulary:
    """What the public ids stand for: whether a word starts with them, and the bytes they add to a word."""

    def __init__(self, path: str, ranks: np.ndarray | None = None):
        """Ids that a model's ``ranks`` do not have are spelled byte by byte."""
        public, edge = load_ranks(path), _edge(path)
        tokens = [b""] * edge
        for token, rank in public.items():
            tokens[rank] = token
        self.starts = np.array([t[:1] == b" " for t in tokens])
        tokens = [t[t[:1] == b" " :] for t in tokens]
        self.sizes = np.array([len(t) for t in tokens])
        ends = np.cumsum(self.sizes)
        self.values = range_values(np.frombuffer(b"".join(tokens), np.uint8), ends - self.sizes, ends)
        self.missing = np.zeros(edge, bool) if ranks is None else ranks[:edge] < 0
        spelled = [[i] for i in range(edge)]
        for i in np.flatnonzero(self.missing).tolist():
            spelled[i] = [public[bytes([b])] for b in (b" " * bool(self.starts[i]) + tokens[i])]
        self._lengths = np.array([len(x) for x in spelled])
        self._first = np.cumsum(self._lengths) - self._lengths
        self._spelled = np.array([i for x in spelled for i in x])

    def spelled(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids in those the model has, and the first one of each document."""
        if not self.missing[ids].any():
            return ids, first
        lengths = self._lengths[ids]
        return self._spelled[spread(self._first[ids], lengths)], np.append(0, np.cumsum(lengths))[first]


class Encoded:
    """A block of ids: as :class:`Text`, the hashes of its words and the first word of each document."""

    def __init__(self, ids: np.ndarray, first: np.ndarray, known: Vocabulary):
        self.ids, self.first, self.size = ids, first, len(first) - 1
        starts = known.starts[ids]
        at = np.flatnonzero(starts)
        self.offsets = np.append(0, np.cumsum(starts))[first]
        self.hashes = joined_hashes(known.values[ids], known.sizes[ids], at, np.append(at[1:], len(ids))[: len(at)])


def ids_of(packed: pa.Array, width: type) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a column, and the first one of each row."""
    if not len(packed):
        return np.zeros(0, width), np.zeros(1, np.int64)
    _, ends, content = packed.buffers()
    first = np.frombuffer(ends, np.int32)[packed.offset : packed.offset + len(packed) + 1].astype(np.int64)
    data = np.frombuffer(content, np.uint8) if content is not None else np.zeros(0, np.uint8)
    return data[first[0] : first[-1]].view(width), (first - first[0]) // width().itemsize


def encoded_blocks(batch: pa.RecordBatch, known: Vocabulary, width: type) -> Iterator[tuple[slice, Encoded]]:
    """The rows of a batch, whose last columns are ``ids`` and ``size``, in the blocks of their texts."""
    packed, size = batch.columns[-2:]
    ids, first = ids_of(packed, width)
    for at, to in cuts_of(np.append(0, np.cumsum(size.to_numpy())), ENCODED_BYTES):
        own = ids[first[at] : first[to]].astype(np.int64)
        yield slice(at, to), Encoded(own, first[at : to + 1] - first[at], known)


# -- training ----------------------------------------------------------------------------------------


def _id_counts(training: DataFrame, path: str, ids: DataFrame | None = None) -> np.ndarray:
    """How often all training texts, or their ``ids``, have each id, and at the end the number of texts."""
    ids, width = encoded(training.select("text"), path) if ids is None else ids, _width(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_edge(path) + 1, np.int64)
        for batch in batches:
            counts += np.bincount(ids_of(batch.column(0), width)[0], minlength=len(counts))
            counts[-1] += batch.num_rows
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], ["id", "n"])

    rows = ids.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_edge(path) + 1, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


def _start(training: DataFrame, path: str, ids: DataFrame | None = None) -> attention.Trainer:
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")]
    sizes = training.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("size"), F.xxhash64("text").alias("tie"))
    first = sizes.orderBy(F.xxhash64("doc_id"), "doc_id", "tie").limit(START_DOCUMENTS).toPandas()
    chosen = first["doc_id"][np.array(that_fit(first["size"].tolist(), START_CHARS), bool)].unique().tolist()
    wanted = training.sparkSession.createDataFrame([(i,) for i in chosen], f"doc_id {training.schema['doc_id'].dataType.simpleString()}")
    wanted = F.broadcast(wanted)
    texts = training.join(wanted, "doc_id", "left_semi").orderBy(*order).select("text").toPandas()["text"]
    words = [Text(block) for block in blocks(pa.array(texts.tolist(), pa.string()))]
    counts = _id_counts(training, path, ids)
    # The model has the most frequent ids, and all bytes, so that it can spell everything.
    seen = np.argsort(-counts, kind="stable")[:VOCABULARY]
    letters = [rank for token, rank in load_ranks(path).items() if len(token) == 1]
    model = attention.new_model(counts, np.union1d(seen[counts[seen] > 0], letters))
    trainer, known = attention.Trainer(model), subword_encoder(path, model.ranks)
    own = [text.ids(known) for text in words]
    for _ in range(START_PASSES):
        for text in own:
            trainer.learn(*text)
    return trainer


def _packed(weights: dict[str, np.ndarray]) -> bytes:
    return b"".join(weights[n].tobytes() for n in sorted(weights))


def _unpacked(raw: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    found, at = {}, 0
    for name in sorted(like):
        size = like[name].nbytes
        found[name] = np.frombuffer(raw[at : at + size], np.float32).reshape(like[name].shape).copy()
        at += size
    return found


def _averaged(models: DataFrame, folder: str) -> bytes | None:
    """The mean of ``models(weights, places)`` by places, ``FAN_IN`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, places = None, 0
        for batch in batches:
            for raw, n in zip(batch.column(0), batch.column(1).to_pylist()):
                own = np.frombuffer(raw.as_buffer(), np.float32).astype(np.float64) * n
                total = own if total is None else total + own
                places += n
        if places:
            mean = (total / places).astype(np.float32).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([mean], pa.binary()), pa.array([places])], ["weights", "places"])

    number = 0
    while True:
        many = -(-models.count() // FAN_IN)
        path = f"{folder}/mean{number}"
        kept = models.select("weights", "places").repartition(max(1, many))
        kept.mapInArrow(run, "weights binary, places long").write.parquet(path)
        models, number = models.sparkSession.read.parquet(path), number + 1
        if many <= 1:
            rows = models.collect()
            return bytes(rows[0].weights) if rows else None


def summed(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and their numbers; the first words stand for ``counts``, all others for one."""
    weights = np.ones(len(words), np.int64)
    weights[: len(counts)] = counts
    order = np.argsort(words)
    words = words[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
    return words[first], np.add.reduceat(weights[order], first) if len(first) else weights


def packed_rows(entries: np.ndarray, keys: np.ndarray, targets: int, others: list, names: list[str]) -> pa.RecordBatch:
    """Entries as one binary value per target, which a hash of their keys decides; nulls for others."""
    target = (mixed(keys.astype(np.uint64)) % np.uint64(targets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    cuts = np.searchsorted(target[order], np.arange(targets + 1))
    some = [t for t in range(targets) if cuts[t] < cuts[t + 1]]
    raw = [entries[order[cuts[t] : cuts[t + 1]]].tobytes() for t in some]
    none = [pa.nulls(len(some), k) for k in others]
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(raw, pa.binary()), *none], names)


@dataclass
class Learned:
    """The model, the number of words and of distinct words, and the frequent ones with their counts."""

    model: attention.Model
    total: int
    distinct: int
    frequent: tuple[np.ndarray, np.ndarray]


def learn(training: DataFrame, path: str, targets: int, ids: DataFrame | None = None) -> Learned:
    """One pass over all training texts, or their ``ids``, and the sums of what its tasks counted."""
    spark, width = training.sparkSession, _width(path)
    ids = encoded(training.select("text"), path) if ids is None else ids
    trained = _start(training, path, ids)
    start = trained.model
    shared = spark.sparkContext.broadcast((start, trained.sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, sums = shared.value
        model = attention.Model({n: w.copy() for n, w in begun.weights.items()}, begun.ranks)
        trainer, known = attention.Trainer(model, attention.RATE / 2, sums), Vocabulary(path, model.ranks)
        words, counts, held, places, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, 0

        def counted() -> pa.RecordBatch:
            entries = np.zeros(len(words), _COUNT)
            entries["word"], entries["n"] = words, counts
            return packed_rows(entries, words, targets, [pa.int64(), pa.binary(), pa.int64()], names)

        for batch in batches:
            for _, text in encoded_blocks(batch, known, width):
                held.append(text.hashes)
                total += len(text.hashes)
                if sum(map(len, held)) > ROWS_AT_ONCE:
                    words, counts = summed(np.concatenate([words, *held]), counts)
                    held = []
                    if len(words) > ROWS_AT_ONCE:
                        yield counted()
                        words, counts = words[:0], counts[:0]
                places += trainer.learn(*known.spelled(text.ids, text.first))
        words, counts = summed(np.concatenate([words, *held]), counts)
        yield counted()
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(1, pa.int32()),
                pa.nulls(1, pa.binary()),
                pa.array([total]),
                pa.array([_packed(model.weights) if places else None], pa.binary()),
                pa.array([places]),
            ],
            names,
        )

    names = ["target", "packed", "total", "weights", "places"]
    folder = work_folder(spark, "language_model")
    rows = ids.select("ids", "size").mapInArrow(tidied(run), "target int, packed binary, total long, weights binary, places long")
    rows.write.parquet(f"{folder}/learned")
    learned = spark.read.parquet(f"{folder}/learned")
    mean = _averaged(learned.where("weights is not null"), folder)
    model = attention.Model(_unpacked(mean, start.weights), start.ranks) if mean else start
    total = int(learned.agg(F.sum("total")).first()[0] or 0)
    least = total // FREQUENT  # more of them than this are at most FREQUENT words

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.zeros(0, _COUNT)]
        for batch in batches:
            parts += [np.frombuffer(x, _COUNT) for x in batch.column(1).to_pylist()]
        entries = np.concatenate(parts)
        words, n = summed(entries["word"], entries["n"])
        often = n > least
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([len(words)] + [0] * int(often.sum()), pa.int64()),
                pa.array([0, *words[often].view(np.int64).tolist()], pa.int64()),
                pa.array([0, *n[often].tolist()], pa.int64()),
            ],
            ["distinct", "word", "n"],
        )

    counts = learned.where("packed is not null").select("target", "packed")
    counts = counts.repartitionById(targets, F.col("target"))
    found = counts.mapInArrow(add_up, "distinct long, word long, n long").toPandas()
    often = found[found["n"] > 0]  # the others tell how many words a task has
    hashes = often["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Learned(model, total, int(found["distinct"].sum()), (hashes[order], often["n"].to_numpy(np.int64)[order]))


# -- scoring -------------------------------------------------------------------------------------------


def score(documents: DataFrame, held_out: Column, path: str) -> DataFrame:
    """Scores of all documents after learning from those that are not held out.

    Columns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    spark, width = documents.sparkSession, _width(path)
    targets = targets_for(documents)
    trained = ~held_out & F.col("doc_id").isNotNull()
    folder = work_folder(spark, "language_model")
    rows = encoded(documents.select("doc_id", held_out.alias("held_out"), trained.alias("trained"), "text"), path)
    rows.write.parquet(f"{folder}/encoded")
    every = spark.read.schema(rows.schema).parquet(f"{folder}/encoded")
    learned = learn(documents.where(trained), path, targets, every.where("trained"))
    ends = every.where("trained").count()
    tokens, distinct = learned.total + ends, learned.distinct + (ends > 0)
    shared = spark.sparkContext.broadcast((learned.model, learned.frequent))
    floor = float(np.log10(tokens + distinct + 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (frequent, counts) = shared.value
        known = Vocabulary(path, model.ranks)
        row = TaskContext.get().partitionId() << 40
        held, many = [], 0

        for batch in batches:
            for own, text in encoded_blocks(batch, known, width):
                scores = attention.score_texts(model, *known.spelled(text.ids, text.first))
                rows = row + np.arange(text.size)
                row += text.size
                of = owners(text.offsets)
                words, which = np.unique(text.hashes, return_inverse=True)
                at = np.minimum(np.searchsorted(frequent, words), max(0, len(frequent) - 1))
                common = frequent[at] == words if len(frequent) else np.zeros(len(words), bool)
                shares = np.where(common, np.log10(counts[at] + 1), 0) if len(frequent) else np.zeros(len(words))
                base = np.bincount(of, shares[which], text.size)
                base = base + np.log10(ends + 1) - (np.diff(text.offsets) + 1) * floor
                seen = np.bincount(of, common[which], text.size).astype(np.int64) + (ends > 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((mixed(rows.astype(np.uint64)) % np.uint64(targets)).astype(np.int32)),
                        pa.nulls(text.size, pa.binary()),
                        pa.array(rows),
                        *(batch.column(i)[own] for i in (0, 1)),
                        pa.array(np.diff(text.offsets) + 1),
                        pa.array(seen),
                        pa.array(base),
                        pa.array(scores),
                    ],
                    names,
                )
                rare = ~common[which]
                pairs, times = np.unique(of[rare] * len(words) + which[rare], return_counts=True)
                of, which = np.divmod(pairs, max(1, len(words)))
                entries = np.zeros(len(pairs), _ENTRY)
                entries["word"], entries["row"], entries["times"] = words[which], rows[of], times
                learned_from = batch.column(2)[own].to_numpy(zero_copy_only=False)
                entries["trained"] = np.where(learned_from[of], times, 0)
                held.append(entries)
                many += len(entries)
                if many > ROWS_AT_ONCE // 2:
                    yield packed_rows(every := np.concatenate(held), every["word"], targets, kinds[2:], names)
                    held, many = [], 0
        if many:
            yield packed_rows(every := np.concatenate(held), every["word"], targets, kinds[2:], names)

    def count_rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.zeros(0, _ENTRY)]
        for batch in batches:
            raw = batch.column(1)
            parts += [np.frombuffer(x, _ENTRY) for x in raw.drop_null().to_pylist()]
            yield batch.filter(raw.is_null())
        entries = np.concatenate(parts)
        del parts
        _, which = np.unique(entries["word"], return_inverse=True)
        n = np.bincount(which, entries["trained"])[which] if len(which) else np.zeros(0)
        rows, of = np.unique(entries["row"], return_inverse=True)
        found = np.zeros(len(rows), _PART)
        found["row"] = rows
        found["base"] = np.bincount(of, entries["times"] * np.log10(n + 1), len(rows))
        found["known"] = np.bincount(of, np.where(n > 0, entries["times"], 0), len(rows))
        yield packed_rows(found, rows, targets, kinds[2:], names)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, whole = [np.zeros(0, _PART)], []
        for batch in batches:
            raw = batch.column(1)
            parts += [np.frombuffer(x, _PART) for x in raw.drop_null().to_pylist()]
            whole.append(batch.filter(raw.is_null()))
        found = np.concatenate(parts)
        keys = [r.column(2).to_numpy() for r in whole]
        every = np.sort(np.concatenate([np.zeros(0, np.int64), *keys]))
        at = np.searchsorted(every, found["row"])
        base = np.bincount(at, found["base"], len(every)).astype(np.float64)
        seen = np.bincount(at, found["known"], len(every)).astype(np.int64)
        for rows, key in zip(whole, keys):
            at = np.searchsorted(every, key)
            yield pa.RecordBatch.from_arrays(
                [
                    *rows.columns[3:6],
                    pa.array(rows.column(6).to_numpy() + seen[at]),
                    pa.array(rows.column(7).to_numpy() + base[at]),
                    rows.column(8),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    whole_row = f"target int, packed binary, row long, {result}"
    names = ["target", "packed", "row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    id_type = {"string": pa.string(), "int": pa.int32()}.get(kind, pa.int64())
    kinds = [pa.int32(), pa.binary(), pa.int64(), id_type, pa.bool_(), *[pa.int64()] * 2, *[pa.float64()] * 2]
    sent = every.mapInArrow(tidied(send), whole_row).repartitionById(targets, F.col("target"))
    rare = sent.mapInArrow(count_rare, whole_row).repartitionById(targets, F.col("target"))
    return rare.mapInArrow(add_up, result).withColumn("train_tokens", F.lit(tokens).cast("long"))
