"""Substring dedup (operator 6): repeated word windows found by recompression.

Every text is recompressed in rounds.  A round names maximal runs of equal symbols, then pairs of a
left and a right symbol, the sides being a hash of the symbol in that round.  A name is a 64-bit
hash of what it stands for, so all tasks give equal names without exchanging a table, and equal
stretches of text get equal symbols but for a margin: what touches an end of a stretch may have
joined with something outside.  The margin is known from the stretch alone (its first and last run;
then a first symbol that is a right one, a last that is a left one).

So a window of ``window`` words has an interior of symbols that every copy of the window has at the
same place.  Its anchor is the interior symbol of the last round with the smallest hash; its key
names that symbol with one word of context per round on both sides, which the margin guarantees to
lie inside the window.  Neighbouring windows share anchors: about one key per seven words is sent
(a window with nothing left inside, as in one long run, is its own key).  Each key carries a 64-bit
hash of every window it stands for.  Windows are equal if key, place relative to the anchor and
hash agree; of equal ones all but the first, by document id and start, are repeats.  Two different
windows that share their anchor words are taken for equal with a chance of 2^-64, so a phrase in a
billion otherwise different documents gives 0.03 false repeats at a place.

Keys travel packed, one array per task and target; copies within a task are resolved there, so a
passage that very many documents share costs one entry per task, not one per document.

Defined results: a null text has no words; a document shorter than the window is never changed;
texts of any length are read whole, the document being the unit of memory; documents without an id
come last; rows with equal id and text are one document and get the same result each; rows with the
same id but other text are ordered by a hash of the text; an empty table gives no rows; further
columns are passed through or ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import blocks, mixed, range_hashes, spread, tidied, values_of, words_of
from fieldpulse.llm.exchange import SORTED_CHARS_PER_TARGET, targets_for

WINDOW = 20
ROUNDS = 2
#: Keys a task gathers before it resolves its own copies and sends them.
KEYS_AT_ONCE = 200_000
_LAST_ID = np.iinfo(np.int64).max
_STEP = np.uint64(0x9FB21C651E98DF25)
_STEP_INVERSE = np.uint64(pow(0x9FB21C651E98DF25, -1, 1 << 64))

_ENTRY = np.dtype(
    [("key", "<u8"), ("doc", "<i8"), ("twin", "<i4"), ("at", "<i4"), ("first", "<i4"), ("many", "<u2")]
)


# -- recompression of the texts of a block ---------------------------------------------------------


class _Sequences:
    """Sums over a symbol sequence that give a hash of any stretch of it."""

    def __init__(self, symbols: np.ndarray):
        size = len(symbols) + 1
        up, down = np.full(size, _STEP), np.full(size, _STEP_INVERSE)
        up[0] = down[0] = 1
        up, self._down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        self._sums = np.append(np.uint64(0), np.cumsum(symbols * up[:-1]))

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        values = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        return mixed(values + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def _round(symbols: np.ndarray, starts: np.ndarray, fresh: np.ndarray, low: np.ndarray, high: np.ndarray, salt: int):
    """One round: name runs, then pairs.

    ``starts`` are the word positions of the symbols, ``fresh`` marks the first of each document,
    ``low`` and ``high`` bound each window's interior as symbol numbers.  All are returned anew.
    """
    new_run = fresh.copy()
    new_run[1:] |= symbols[1:] != symbols[:-1]
    run_of = np.cumsum(new_run) - 1
    heads = np.flatnonzero(new_run)
    lengths = np.diff(np.append(heads, len(symbols))).astype(np.uint64)
    named = symbols[heads]
    long = lengths > 1
    named[long] = mixed(named[long] + lengths[long] * np.uint64(0x8CB92BA72F3D8DD7))
    starts, fresh = starts[heads], fresh[heads]
    some = low < high
    low, high = np.where(some, run_of[np.minimum(low, len(symbols) - 1)] + 1, 0), np.where(some, run_of[high - 1], 0)

    right = mixed(named + np.uint64(salt)) >> np.uint64(63) == 1
    second = np.zeros(len(named), bool)
    second[1:] = right[1:] & ~right[:-1] & ~fresh[1:]
    some = low < high
    low = np.where(some, low + right[np.minimum(low, len(named) - 1)], 0)
    high = np.where(some, high - ~right[high - 1], 0)
    kept = np.flatnonzero(~second)
    symbol_of = np.cumsum(~second) - 1
    paired = np.append(second[1:], False)[kept]
    left = kept[paired]
    result = named[kept]
    result[paired] = mixed(named[left] * np.uint64(0xC2B2AE3D27D4EB4F) + named[left + 1] + np.uint64(salt))
    some = low < high
    low, high = (
        np.where(some, symbol_of[np.minimum(low, len(named) - 1)], 0),
        np.where(some, symbol_of[high - 1] + 1, 0),
    )
    return result, starts[kept], fresh[kept], low, high


def _smallest_inside(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the smallest value of each range ``low .. high - 1`` is; the leftmost of equal ones."""
    bits = np.uint64(max(1, int(len(values)).bit_length()))
    marked = (values >> bits << bits) | np.arange(len(values), dtype=np.uint64)
    size = high - low
    best = np.zeros(len(low), np.uint64)
    table, width = marked, 1
    most = int(size.max(initial=0))
    while width <= most:
        some = (size >= width) & (size < 2 * width)
        best[some] = np.minimum(table[low[some]], table[high[some] - width])
        longer = table.copy()
        longer[:-width] = np.minimum(table[:-width], table[width:])
        table, width = longer, 2 * width
    return (best & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def keys_of(words: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
    """The keys of all windows of documents whose word hashes stand one after the other.

    Per key: its hash, the word number of its place, its first window and how many windows in a row
    it stands for; and a 64-bit hash per window of the documents, in order of ``windows``.
    """
    sizes = np.diff(offsets)
    many = np.maximum(sizes - window + 1, 0)
    windows = spread(offsets[:-1], many)
    if not len(windows):
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    plain = _Sequences(words)
    whole = plain.hashes(windows, windows + window)
    symbols, starts = words, np.arange(len(words))
    fresh = np.zeros(len(words), bool)
    fresh[offsets[:-1][sizes > 0]] = True
    low, high = windows, windows + window
    for number in range(ROUNDS):
        symbols, starts, fresh, low, high = _round(symbols, starts, fresh, low, high, 0x51ED270B * (number + 1))
    inside = low < high
    anchor = np.full(len(windows), -1, np.int64)
    anchor[inside] = _smallest_inside(mixed(symbols + np.uint64(1)), low[inside], high[inside])
    # A new key where the anchor changes or the windows are not neighbours; without one, each its own.
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(new)
    of, first = anchor[head], windows[head]
    at, key = first.copy(), whole[head]
    good = of >= 0
    ends = np.append(starts[1:], len(words))
    at[good] = starts[of[good]]
    key[good] = plain.hashes(at[good] - ROUNDS, ends[of[good]] + ROUNDS)
    return key, at, first, np.diff(np.append(head, len(windows))), whole


# -- repeats among keys ---------------------------------------------------------------------------


def repeats(entries: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the windows (in order of the entries) have an equal one that comes earlier."""
    many = entries["many"].astype(np.int64)
    first = np.cumsum(many) - many
    _, which, counts = np.unique(entries["key"], return_inverse=True, return_counts=True)
    shared = np.flatnonzero(counts[which] > 1)
    found = np.zeros(len(hashes), bool)
    if not len(shared):
        return found
    at = spread(first[shared], many[shared])
    entry = np.repeat(shared, many[shared])
    start = entries["first"][entry] + (at - first[entry])
    place = (start - entries["at"][entry]).astype(np.int64)
    order = np.lexsort((start, entries["twin"][entry], entries["doc"][entry], hashes[at], place, which[entry]))
    a, b = order[1:], order[:-1]
    same = (which[entry[a]] == which[entry[b]]) & (place[a] == place[b]) & (hashes[at[a]] == hashes[at[b]])
    # Rows with equal id and text are one document, so an equal start there is the window itself.
    itself = (start[a] == start[b]) & (entries["doc"][entry[a]] == entries["doc"][entry[b]])
    itself &= entries["twin"][entry[a]] == entries["twin"][entry[b]]
    chain = same & itself
    repeat = same & ~itself
    if chain.any():  # the window itself once more: a repeat if the one before is
        group = np.cumsum(~np.append(False, chain)) - 1
        repeat = np.append(False, repeat)
        by_group = np.zeros(group[-1] + 1, bool)
        by_group[group[repeat]] = True
        found[at[order]] = by_group[group]
    else:
        found[at[a[repeat]]] = True
    return found


def spans(entries: np.ndarray, found: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Repeats as word ranges, merged per document: document, twin, first word, word after the last."""
    many = entries["many"].astype(np.int64)
    at = np.flatnonzero(found)
    ends = np.cumsum(many)
    entry = np.searchsorted(ends, at, side="right")
    start = entries["first"][entry] + at - (ends - many)[entry]
    return _merged(entries["doc"][entry], entries["twin"][entry], start, window)


def _merged(doc: np.ndarray, twin: np.ndarray, start: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Windows that touch or overlap in a document as one range."""
    order = np.lexsort((start, twin, doc))
    doc, twin, start = doc[order], twin[order], start[order]
    new = np.ones(len(start), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (twin[1:] != twin[:-1]) | (start[1:] > start[:-1] + window)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(start))[: len(head)] - 1
    return doc[head], twin[head], start[head], start[tail] + window


def _without_own_copies(entries: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries that another of the task equals in key, place and all windows, but for the first one."""
    many = entries["many"].astype(np.int64)
    ends = np.cumsum(many)
    print_ = _Sequences(hashes).hashes(ends - many, ends)
    print_ = mixed(print_ ^ entries["key"]) + (entries["first"] - entries["at"]).astype(np.uint64)
    order = np.lexsort((entries["first"], entries["twin"], entries["doc"], print_))
    later = np.zeros(len(entries), bool)
    later[order[1:]] = print_[order[1:]] == print_[order[:-1]]
    return later, np.repeat(later, many)


def _packed(entries: np.ndarray, hashes: np.ndarray) -> bytes:
    return len(entries).to_bytes(8, "little") + entries.tobytes() + hashes.astype("<u8").tobytes()


def _unpacked(raw: bytes | memoryview) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(raw[:8], "little")
    cut = 8 + size * _ENTRY.itemsize
    return np.frombuffer(raw[8:cut], _ENTRY), np.frombuffer(raw[cut:], "<u8")


_SPAN = "doc long, twin int, start int, stop int"


def _span_batch(columns) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc", "twin", "start", "stop"]
    )


def identity(id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """What orders documents: the id, last without one, and a hash of the text."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)), F.hash(F.col(text_col))


def repeated_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc, twin, start, stop``: word ranges that repeat earlier text; ranges may overlap."""
    targets = targets_for(documents, share=SORTED_CHARS_PER_TARGET)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_hashes, held_many, turn = [], [], 0, 0
        task = TaskContext.get().partitionId()

        def flush() -> Iterator[pa.RecordBatch]:
            entries, hashes = np.concatenate(held), np.concatenate(held_hashes)
            held.clear()
            held_hashes.clear()
            later, of_window = _without_own_copies(entries, hashes)
            # What is known to repeat goes straight on, as ranges, to the targets in turn.
            doc, twin, start, stop = spans(entries, of_window, window)
            known = np.zeros(len(doc), _ENTRY)
            known["doc"], known["twin"], known["first"], known["at"] = doc, twin, start, stop
            to = [(task + turn) % targets]
            raw = [b"S" + _packed(known, np.zeros(0, np.uint64))]
            entries, hashes = entries[~later], hashes[~of_window]
            many = entries["many"].astype(np.int64)
            first = np.cumsum(many) - many
            target = (mixed(entries["key"]) % np.uint64(targets)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            cuts = np.searchsorted(target[order], np.arange(targets + 1))
            for t, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())):
                if a < b:
                    some = order[a:b]
                    to.append(t)
                    raw.append(b"K" + _packed(entries[some], hashes[spread(first[some], many[some])]))
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(raw, pa.binary())], ["target", "packed"])

        for batch in batches:
            docs, twins = (batch.column(i).to_numpy() for i in (0, 1))
            for block in blocks(batch.column(2)):
                words = words_of(block.data, block.offsets)
                hashed = range_hashes(block.data, words.starts, words.ends)
                key, at, first, many, hashes = keys_of(hashed, words.offsets, window)
                doc = np.searchsorted(words.offsets, first, side="right") - 1
                base = words.offsets[doc]
                entries = np.zeros(len(key), _ENTRY)
                entries["key"], entries["many"] = key, many
                entries["doc"], entries["twin"] = docs[block.first + doc], twins[block.first + doc]
                entries["at"], entries["first"] = at - base, first - base
                held.append(entries)
                held_hashes.append(hashes)
                held_many += len(entries)
                if held_many >= KEYS_AT_ONCE:
                    yield from flush()
                    held_many, turn = 0, turn + 1
        if held_many:
            yield from flush()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, hashes = [np.zeros(0, _ENTRY)], [np.zeros(0, np.uint64)]
        for batch in batches:
            for raw in values_of(batch.column(1)):
                own, own_hashes = _unpacked(raw[1:])
                if raw[:1] == b"S":
                    yield _span_batch((own["doc"], own["twin"], own["first"], own["at"]))
                else:
                    entries.append(own)
                    hashes.append(own_hashes)
        entry, hashed = np.concatenate(entries), np.concatenate(hashes)
        del entries, hashes  # before the sorts, which take as much again
        yield _span_batch(spans(entry, repeats(entry, hashed), window))

    doc, twin = identity()
    rows = documents.select(doc.alias("doc"), twin.alias("twin"), "text").where("text is not null")
    packed = rows.mapInArrow(tidied(send), "target int, packed binary")
    return packed.repartitionById(targets, F.col("target")).mapInArrow(tidied(resolve), _SPAN)


# -- documents without their repeats ---------------------------------------------------------------


def _with_spans(documents: DataFrame, window: int) -> DataFrame:
    """Documents with ``starts`` and ``stops`` of their repeats; null without any."""
    doc, twin = identity()
    found = (
        repeated_spans(documents, window)
        .groupBy("doc", "twin")
        .agg(F.collect_list(F.struct("start", "stop")).alias("repeats"))
        .select("doc", "twin", F.col("repeats.start").alias("starts"), F.col("repeats.stop").alias("stops"))
    )
    marked = documents.withColumns({"doc": doc, "twin": twin})
    return marked.join(found.hint("shuffle_hash"), ["doc", "twin"], "left")


def _kept(block, starts: pa.Array, stops: pa.Array):
    """Words of a block, which of them stay, and the kept words of each document joined by spaces."""
    words = words_of(block.data, block.offsets)
    change = np.zeros(len(words.starts) + 1, np.int64)
    low, high = starts.offsets.to_numpy(), stops.offsets.to_numpy()
    of = np.repeat(np.arange(block.size), np.diff(low))
    begin = words.offsets[of] + starts.values.to_numpy()[low[0] : low[-1]]
    end = words.offsets[of] + stops.values.to_numpy()[high[0] : high[-1]]
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    stays = np.cumsum(change)[:-1] == 0
    at = words.starts[stays]
    size = words.ends[stays] - at + 1
    data = np.append(block.data, np.uint8(0x20))[spread(at, size)]
    upto = np.append(0, np.cumsum(size))
    data[upto[1:] - 1] = 0x20
    kept_before = np.append(0, np.cumsum(stays))[words.offsets]
    return words, kept_before, data.tobytes(), upto[kept_before]


def _blocks_with_spans(batch: pa.RecordBatch, text: int, starts: int, stops: int):
    for block in blocks(batch.column(text)):
        low = batch.column(starts).slice(block.first, block.size)
        high = batch.column(stops).slice(block.first, block.size)
        empty = pa.array([[]], low.type)[0]
        yield block, low.fill_null(empty), high.fill_null(empty)


def digests(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, low, high in _blocks_with_spans(batch, 1, 2, 3):
                words, kept_before, data, cuts = _kept(block, low, high)
                counts = np.diff(words.offsets)
                ends = cuts.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array(counts),
                        pa.array(counts - np.diff(kept_before)),
                        pa.array([hashlib.sha256(data[a : max(a, b - 1)]).hexdigest() for a, b in zip(ends, ends[1:])]),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(documents.select("doc_id", "text"), window)
    return rows.select("doc_id", "text", "starts", "stops").mapInArrow(
        tidied(run), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string"
    )


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Documents with all their columns; a text with repeats becomes its kept words, joined by spaces."""
    columns = documents.columns
    place = columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, low, high in _blocks_with_spans(batch, place, len(columns), len(columns) + 1):
                _, _, data, cuts = _kept(block, low, high)
                rows = batch.slice(block.first, block.size)
                texts, ends = rows.column(place).to_pylist(), cuts.tolist()
                for i in np.flatnonzero(np.diff(low.offsets.to_numpy())).tolist():
                    texts[i] = data[ends[i] : max(ends[i], ends[i + 1] - 1)].decode("utf-8")
                own = [rows.column(i) for i in range(len(columns))]
                own[place] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(own, columns)

    numbered = documents.toDF(*[f"c{i}" for i in range(len(columns))])  # names of any kind and case
    keyed = numbered.withColumnsRenamed({f"c{place}": "text", f"c{columns.index('doc_id')}": "doc_id"})
    rows = _with_spans(keyed, window).select(*keyed.columns, "starts", "stops")
    return rows.mapInArrow(tidied(run), documents.schema)
