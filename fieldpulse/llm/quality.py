"""Quality classifier (operator 5): supervised subword embeddings.

Every word, pair of neighbouring words and character n-gram inside a word is a feature that is
hashed to one of ``BUCKETS`` vectors.  A document is the mean of its features' vectors, a softmax
over two classes follows, and vectors and output are trained together by stochastic gradient
descent in numpy.  A word that follows itself is one feature of its own, whatever the word.

Training reads the whole texts of at most ``SAMPLE_ROWS`` labelled documents with at most
``SAMPLE_CHARS`` characters together, chosen by a hash of their id: a documented bound, so the
model and the driver's memory do not grow with the table.  Scoring is a single pass without any
shuffle; as mean and output are linear, a trained feature is one number there.

Defined results: null and empty texts have the score of the bias alone; texts of any length are
read whole; equal texts have equal scores; a document with several labels counts with the smallest,
null labels are left out; without any usable label the score is 0.5; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import Block, blocks, lowered, mixed, owners, range_hashes, that_fit, tidied, words_of

BUCKETS = 1 << 17
DIMENSIONS = 8
GRAM_SIZES = (3, 4)
EPOCHS = 8
RATE = 0.5
SAMPLE_ROWS = 3_000
SAMPLE_CHARS = 16_000_000
ACCEPTED_FROM = 0.7
#: Bytes of text whose features are made together.
BLOCK = 1 << 19

_REPEATED = np.uint64(1)


@dataclass
class Model:
    """What a feature adds to the difference of the two outputs, and the bias."""

    weights: np.ndarray
    bias: float


def features_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and document number of every feature of a block."""
    data = lowered(block.data)
    words = words_of(data, block.offsets)
    if not len(words.starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    of_word = owners(words.offsets)
    hashes = range_hashes(data, words.starts, words.ends)
    same = of_word[1:] == of_word[:-1]
    pairs = mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    pairs[hashes[1:] == hashes[:-1]] = _REPEATED
    found, of = [hashes, pairs[same]], [of_word, of_word[1:][same]]
    for size in GRAM_SIZES:
        room = np.maximum(words.ends - words.starts - size + 1, 0)
        starts = np.repeat(words.starts - np.cumsum(room) + room, room) + np.arange(room.sum())
        found.append(range_hashes(data, starts, starts + size) + np.uint64(size))
        of.append(np.repeat(of_word, room))
    buckets = np.concatenate([(h % np.uint64(BUCKETS)).astype(np.int32) for h in found])
    return buckets, np.concatenate(of)


def train(texts: list[str], labels: list[int], seed: int = 7) -> Model:
    """Plain SGD over documents as sparse mean vectors."""
    if not texts or len(set(labels)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    sparse = []
    for block in blocks(pa.array(texts, pa.string()), BLOCK):
        buckets, of = features_of(block)
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(block.size + 1))
        for a, b in zip(cuts, cuts[1:]):
            which, count = np.unique(buckets[order[a:b]], return_counts=True)
            sparse.append((which, (count / max(1, b - a)).astype(np.float32)))
    pick = np.random.default_rng(seed)
    vectors = pick.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    output[1], output[0] = 0.1, -0.1
    steps, done = EPOCHS * len(sparse), 0
    for _ in range(EPOCHS):
        for i in pick.permutation(len(sparse)):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            which, share = sparse[i]
            mean = share @ vectors[which] if len(which) else np.zeros(DIMENSIONS, np.float32)
            raw = output @ mean + bias
            chance = np.exp(raw - raw.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            back = chance @ output
            output -= rate * np.outer(chance, mean)
            bias -= rate * 0.1 * chance
            # A mean of many features moves each a little; scaled so that the mean moves by the rate.
            if len(which):
                vectors[which] -= (rate / np.float32(share @ share)) * np.outer(share, back) * np.float32(0.2)
    return Model((vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0]))


def score_block(block: Block, model: Model) -> np.ndarray:
    buckets, of = features_of(block)
    total = np.bincount(of, model.weights[buckets], block.size).astype(np.float64)
    count = np.bincount(of, minlength=block.size)
    raw = model.bias + total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def labelled_sample(documents: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Whole texts and labels of a bounded number of documents, the same for any partitioning.

    Only ids and labels are sorted; the chosen ids travel to the texts, not the other way.
    """
    chosen = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
        .collect()
    )
    session = documents.sparkSession
    marks = F.broadcast(session.createDataFrame(chosen, "doc_id long, quality int"))
    known = documents.select("doc_id", "text").join(marks, "doc_id")
    order = [F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")]
    size = F.coalesce(F.length("text"), F.lit(0)).alias("n")
    sizes = known.orderBy(*order).select("doc_id", F.xxhash64("text").alias("tie"), size).toPandas()
    some = sizes[np.array(that_fit(sizes["n"].tolist(), SAMPLE_CHARS), bool)]
    # Equal rows are told apart by their number, so that no more of them come than fit.
    some = some.groupby(["doc_id", "tie"], as_index=False).size()
    wanted = session.createDataFrame(
        [(int(d), int(t), int(n)) for d, t, n in some.itertuples(index=False)], "doc_id long, tie long, many long"
    )
    turn = F.row_number().over(Window.partitionBy("doc_id", "tie").orderBy("doc_id"))
    rows = known.withColumn("tie", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "tie"])
    rows = rows.withColumn("turn", turn).where("turn <= many").orderBy(*order).select("doc_id", "text", "quality").toPandas()
    return rows["text"].fillna("").tolist(), rows["quality"].tolist()


def score(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted`` of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                scores = score_block(block, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array(scores),
                        pa.array((scores >= ACCEPTED_FROM).astype(np.int32)),
                    ],
                    ["doc_id", "score", "predicted"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, predicted int"
    )


def accepted(documents: DataFrame, model: Model) -> DataFrame:
    """The documents whose score is at least ``ACCEPTED_FROM``, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(place), BLOCK):
                good = score_block(block, shared.value) >= ACCEPTED_FROM
                yield batch.slice(block.first, block.size).filter(pa.array(good))

    return documents.mapInArrow(tidied(run), documents.schema)
