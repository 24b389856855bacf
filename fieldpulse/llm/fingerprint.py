"""Document fingerprints (operator 3): randomised edit embedding with bit-sampled banding.

All texts take the same random walk over their characters: at step ``j`` a text writes the
character it stands on, and a shared random bit of ``j`` and that character decides whether it
moves on.  Two texts that differ by an edit fall out of step there and soon back into step, so few
edits leave the outputs equal at most steps: edit distance becomes Hamming distance.  Outputs of
all texts of a block are written side by side, one step at a time.

A fingerprint keeps the outputs at sampled steps: on level ``l`` every ``2 ** l``-th step, so each
level is contained in the one below; a text uses the level that leaves between half of ``SAMPLES``
and ``SAMPLES`` of them, and texts of different lengths are compared at the coarser level.  Likeness
is the share of equal outputs among the samples of the longer walk.
Bands are groups of ``BAND`` neighbouring samples; two texts are compared only if they share a band,
and have likeness 0 otherwise.

A fingerprint reads ``level:two hex digits per sample``.  Defined results: a null text counts as
empty, with fingerprint ``0:``; two empty texts have likeness 1, an empty and another text 0; equal
texts have equal fingerprints; texts of any length are walked to their end; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.session import work_folder

SAMPLES = 96
BAND = 4
NEAR = 0.8
#: Documents of a band that its other members are compared with in the first round.
HEADS = 1
#: Texts of a block walk together; characters of a block.
BLOCK_CHARS = 8 << 20
#: So many texts walk alone, where a step of an array costs more than theirs one by one.
FEW = 32
BUCKET_CHARS = 16 << 20
_PERIOD = 1 << 14
_SIGNS = 1 << 6


@cache
def _moves() -> np.ndarray:
    """Shared random bits: whether a text moves on, per step and character; steps repeat."""
    return np.random.default_rng(31).integers(0, 2, (_PERIOD, _SIGNS), dtype=np.int64)


@cache
def _moves_as_bytes() -> bytes:
    return _moves().astype(np.uint8).tobytes()


def own_level(size: np.ndarray) -> np.ndarray:
    """The level of texts by their length: about two steps a character, ``SAMPLES`` of them kept."""
    return np.maximum(0, np.ceil(np.log2(np.maximum(2 * size, 1) / SAMPLES))).astype(np.int64)


def signs_of(texts: list[str]) -> np.ndarray:
    """A byte for each character of all texts, one after the other."""
    parts = [np.zeros(0, np.uint8)]
    for text in texts:
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        parts.append(((codes * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint8))
    return np.concatenate(parts)


def _walk_on(raw: bytes, step: int, here: int, stop: int, limit: int, level: int) -> bytes:
    """The rest of one walk."""
    moves, out, every = _moves_as_bytes(), bytearray(), (1 << level) - 1
    while here < stop and step < limit:
        sign = raw[here]
        if step & every == every:
            out.append(sign)
        here += moves[(step % _PERIOD) * _SIGNS + sign % _SIGNS]
        step += 1
    return bytes(out)


def walk(signs: np.ndarray, sizes: np.ndarray) -> list[tuple[int, bytes]]:
    """Level and samples of texts that stand one after the other.

    All texts take each step together; the few longest finish alone.  A walk ends with its text, or
    after three steps a character.
    """
    first, own = np.cumsum(sizes) - sizes, own_level(sizes)
    order = np.argsort(-sizes, kind="stable")
    lane = order[sizes[order] > 0]
    here, size = first[lane], sizes[lane]
    stop, limit, falling = here + size, 3 * size, -own[lane]
    signs = np.append(signs, np.uint8(0))
    narrow = signs & np.uint8(_SIGNS - 1)
    moves = _moves()
    lanes, values = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
    step = 0
    while len(lane) > FEW:
        for step in range(step, step + 64):
            walking = here < stop
            level = ((step + 1) & -(step + 1)).bit_length() - 1
            if (low := int(np.searchsorted(falling, -level))) < len(lane):
                taken = walking[low:] & (step < limit[low:])
                lanes.append(lane[low:][taken])
                values.append(signs[here[low:][taken]])
            here = here + (moves[step % _PERIOD][narrow[here]] & walking)
        step += 1
        running = (here < stop) & (step < limit)
        if not running.all():
            lane, here, stop = lane[running], here[running], stop[running]
            limit, falling = limit[running], falling[running]
    of, value = np.concatenate(lanes), np.concatenate(values)
    by = np.argsort(of, kind="stable")
    raw, cuts = value[by].tobytes(), np.searchsorted(of[by], np.arange(len(sizes) + 1))
    found = [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
    for i, at, end, most in zip(lane.tolist(), here.tolist(), stop.tolist(), limit.tolist()):
        text = signs[at:end].tobytes()
        found[i] += _walk_on(text, step, 0, end - at, most, int(own[i]))
    return list(zip(own.tolist(), found))


def at_level(print_: tuple[int, bytes], level: int) -> np.ndarray:
    """The samples of a coarser level: every second, fourth ... one."""
    step = 1 << (level - print_[0])
    return np.frombuffer(print_[1], np.uint8)[step - 1 :: step]


def likeness(one: tuple[int, bytes], two: tuple[int, bytes], banded: bool = True) -> float:
    """Share of equal samples; 0 for texts that share no band."""
    level = max(one[0], two[0])
    a, b = at_level(one, level), at_level(two, level)
    most, both = max(len(a), len(b)), min(len(a), len(b))
    if not most:
        return 1.0 if one == two else 0.0
    same = a[:both] == b[:both]
    full = len(same) // BAND * BAND
    if banded and both >= BAND and most >= BAND and not same[:full].reshape(-1, BAND).all(1).any():
        return 0.0
    return float(same.sum()) / most


def shown(print_: tuple[int, bytes]) -> str:
    return f"{print_[0]}:{print_[1].hex()}"


def parsed(text: str) -> tuple[int, bytes]:
    level, _, raw = text.partition(":")
    return int(level), bytes.fromhex(raw)


def _walk_texts(texts: list[str]) -> list[tuple[int, bytes]]:
    return walk(signs_of(texts), np.fromiter(map(len, texts), np.int64, len(texts)))


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.iloc[:, 1].fillna("")
            block = (texts.str.len().cumsum() // BLOCK_CHARS).to_numpy()
            for _, rows in batch.groupby(block):
                prints = _walk_texts(texts[rows.index].tolist())
                yield pd.DataFrame({"doc_id": rows.iloc[:, 0], "fingerprint": [shown(p) for p in prints]})

    kind = documents.schema[id_col].dataType.simpleString()
    return documents.select(id_col, text_col).mapInPandas(run, f"doc_id {kind}, fingerprint string")


def bands(prints: DataFrame) -> DataFrame:
    """One row per document and band, at its own level and the next, where lengths may part."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["fingerprint"]):
                print_ = parsed(text)
                for level in (print_[0], print_[0] + 1):
                    raw = at_level(print_, level).tobytes()
                    whole = [raw[i : i + BAND] for i in range(0, len(raw) - BAND + 1, BAND)]
                    for i, band in enumerate(whole or [raw]):
                        rows.append((doc, f"{level}:{i if whole else 'all'}:{band.hex()}"))
            yield pd.DataFrame(rows, columns=["doc_id", "band"])

    kind = prints.schema["doc_id"].dataType.simpleString()
    return prints.mapInPandas(run, f"doc_id {kind}, band string")


def near_documents(prints: DataFrame, near: float = NEAR) -> DataFrame:
    """Verified links ``doc_id, near_id, likeness`` to the first documents of each shared band.

    The members of a band are compared with its ``HEADS`` smallest.  Those that are near none of them go
    on to the next round, with twice as many heads, until no band has two members left.  So a band that
    many documents share costs each of them few comparisons, not one per pair, and one that an unlike
    document leads still brings the others together.  Rounds are written to the shared folder.
    """

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["likeness"] = [
                likeness(parsed(a), parsed(b)) for a, b in zip(batch["fingerprint"], batch["near_fingerprint"])
            ]
            yield batch.loc[batch["likeness"] >= near, ["doc_id", "near_id", "likeness"]]

    spark, folder, number = prints.sparkSession, work_folder(prints.sparkSession, "near_documents"), 0

    def kept(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}{number}")
        return spark.read.parquet(f"{folder}/{name}{number}")

    prints = prints.where("doc_id is not null").select("doc_id", "fingerprint").distinct()
    other = prints.select(F.col("doc_id").alias("near_id"), F.col("fingerprint").alias("near_fingerprint"))
    kind = prints.schema["doc_id"].dataType.simpleString()
    members, heads, found = kept(bands(prints).distinct(), "members"), HEADS, []
    while not found or not members.isEmpty():
        number += 1
        place = F.row_number().over(Window.partitionBy("band").orderBy("doc_id"))
        first = members.withColumn("place", place).where(F.col("place") <= heads)
        first = first.select("band", F.col("doc_id").alias("near_id"))
        pairs = kept(members.join(first, "band").where("near_id < doc_id"), "pairs")
        judged = pairs.select("doc_id", "near_id").distinct().join(prints, "doc_id").join(other, "near_id")
        links = kept(judged.mapInPandas(verify, f"doc_id {kind}, near_id {kind}, likeness double"), "links")
        found.append(links)
        settled = pairs.join(links, ["doc_id", "near_id"], "left_semi").select("band", "doc_id")
        settled = settled.unionByName(first.select("band", F.col("near_id").alias("doc_id")))
        rest = members.join(settled, ["band", "doc_id"], "left_anti")
        several = rest.groupBy("band").count().where("count > 1")
        members, heads = kept(rest.join(several, "band", "left_semi"), "members"), 2 * heads
    return reduce(DataFrame.unionByName, found).distinct()


# -- each document beside its edited text and its neighbour ----------------------------------------


def with_next(documents: DataFrame) -> tuple[DataFrame, int]:
    """Documents dealt into ranges of descending id, each with a copy of the row that follows it.

    Columns ``bucket, own, doc_id, text``; the copy is not its bucket's own.  Returns the number of
    ranges too.  The text is shuffled once, by the caller; besides cut points and the first id of
    each range nothing comes to the driver.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    many, cuts = max(1, -(-int(total) // BUCKET_CHARS)), []
    if many > 1:
        shares = F.array(*(F.lit(i / many) for i in range(1, many)))
        found = rows.agg(F.percentile_approx("doc_id", shares, F.lit(20 * many))).first()[0]
        cuts = sorted(set(found or []), reverse=True)
    limits = F.array(*map(F.lit, cuts)).cast("array<long>")
    bucket = F.size(F.filter(limits, lambda c: F.col("doc_id") < c))  # 0 holds the largest ids
    placed = rows.withColumn("bucket", F.when(F.col("doc_id").isNull(), len(cuts)).otherwise(bucket))
    heads = placed.groupBy("bucket").agg(F.max("doc_id").alias("head")).orderBy("bucket").collect()
    copies = [(heads[i - 1].bucket, h.bucket, h.head) for i, h in enumerate(heads)]
    jumps = documents.sparkSession.createDataFrame(copies, "goes_to int, bucket int, head long")
    # Of several rows with the first id, the one that sorts first follows.
    heading = (
        placed.join(F.broadcast(jumps), "bucket")
        .where(F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("goes_to")
        .agg(F.min_by(F.struct("doc_id", "text"), F.xxhash64("text")).alias("row"))
        .select(F.col("goes_to").alias("bucket"), "row.*", F.lit(False).alias("own"))
    )
    return placed.withColumn("own", F.lit(True)).unionByName(heading), len(cuts) + 1


def edited_neighbours(documents: DataFrame) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and likenesses.

    The edit replaces the last third of the characters by as many of the next document's first
    ones; the next document is the one with the next smaller id, and after the last comes the first.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(rows) > 1:
                sizes = rows["text"].str.len().cumsum().to_numpy()
                to = max(2, int(np.searchsorted(sizes, BLOCK_CHARS)) + 1)
                yield compared(rows.iloc[:to])
                rows = rows.iloc[min(to, len(rows)) - 1 :]
            held = rows.copy()

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        texts = rows["text"].tolist()
        together = (rows["own"] & (rows["bucket"] == rows["bucket"].shift(-1))).to_numpy()[:-1]
        edited = []
        for text, after in zip(texts, texts[1:]):
            gone = len(text) // 3
            edited.append(text[: len(text) - gone] + after[:gone])
        prints = _walk_texts(texts + edited)
        own, changed = prints[: len(texts)], prints[len(texts) :]
        result = pd.DataFrame(
            {
                "doc_id": rows["doc_id"].iloc[:-1].to_numpy(),
                "n_chars": [len(t) for t in texts[:-1]],
                "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in edited],
                "fingerprint": [shown(p) for p in own[:-1]],
                "edited_fingerprint": [shown(p) for p in changed],
                "near_edited": [likeness(a, b) for a, b in zip(own, changed)],
                "near_next": [likeness(a, b) for a, b in zip(own, own[1:])],
            }
        )
        return result[together]

    rows, buckets = with_next(documents)
    order = ["bucket", F.col("own").desc(), F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    return (
        rows.repartitionById(buckets, F.col("bucket"))
        .sortWithinPartitions(*order)
        .select("bucket", "own", "doc_id", "text")
        .mapInPandas(
            run,
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )
