"""Language identification (operator 2): cross-parsing entropy over suffix automata.

For each language a suffix automaton holds labelled text of at most ``REFERENCE_CHARS`` letters.
A text is parsed greedily into the longest phrases that occur in that text; ``phrases *
log2(reference length) / letters`` estimates its cross entropy, and the language with the smallest
estimate wins.  Parsing runs in steps over arrays: texts are cut into runs of ``RUN`` letters, each
starting a new phrase, and all runs advance together in the automata of all languages by one table
look-up.  This adds at most one phrase per run.

Letters are lower-cased; everything else is one separator.  The reference text is a bounded sample
(whole documents by a hash of their id, as many as fit), so a model is small enough to travel
with the task, where the automata are built once per worker.  A language whose sampled documents are
all longer than the bound is learned from pieces spread over one of them.

Defined results: ``und`` with score 0 for null texts and texts without a letter; with no learned
language everything is ``und``; equal texts get equal results; ties go to the first language by
name; texts of any length are parsed whole; an empty table gives no rows; further columns are
ignored.  ``score`` is ``second / (best + second)`` of the two smallest estimates: 0.5 for a tie,
towards 1 for a clear winner; ``bits`` is the smallest estimate itself, null for ``und``.

Whether a text is in a learned language at all is told by a limit on ``bits`` for its length, since
estimates of short texts vary more.  It is set from held-out text: either half of every reference is
cut into pieces, which are parsed with the other halves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import Block, blocks, tidied

REFERENCE_CHARS = 50_000
SAMPLE_DOCUMENTS = 300
#: Pieces of a document that is longer than a reference.
PIECES = 10
#: Languages whose numbers of documents are broadcast.
FEW_LANGUAGES = 10_000
#: Bytes of text that are parsed together.
BLOCK = 1 << 20
RUN = 512
#: Lengths at which the limit for texts of a learned language is set.
LENGTHS = (2, 5, 10, 20, 40, 80, 160, 320, 640, 1280)
#: The limit is so many times what nine in ten pieces of each learned language need; the rest may be
#: text in another language under a wrong label.
TOLERANCE = 1.5
UNKNOWN = "und"

Model = tuple[tuple[str, str], ...]


@lru_cache(1)
def _folded() -> np.ndarray:
    """The lower-case letter of every code point, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for code in range(0x110000):
        sign = chr(code)
        if sign.isalpha():
            table[code] = ord(sign.lower()[0])
    return table


def letters_of(text: str) -> str:
    """Lower-case letters with one space for all between; used for reference texts."""
    return " ".join("".join(c.lower()[0] if c.isalpha() else " " for c in text).split())


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the start."""
    after: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for sign in text:
        new = len(after)
        after.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state != -1 and sign not in after[state]:
            after[state][sign] = new
            state = link[state]
        if state != -1:
            target = after[state][sign]
            if length[state] + 1 == length[target]:
                link[new] = target
            else:
                twin = len(after)
                after.append(dict(after[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state != -1 and after[state].get(sign) == target:
                    after[state][sign] = twin
                    state = link[state]
                link[target] = link[new] = twin
        last = new
    return after


def _placed(state: np.ndarray, symbol: np.ndarray, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of transitions laid over each other in one table, none on a slot of another's.

    Returns where the row of each state begins, the slot of each transition (``state`` is sorted),
    and for each slot of the table the state that has it, -1 for none.
    """
    degree = np.bincount(state, minlength=states)
    first = np.cumsum(degree) - degree
    reach = int(symbol.max(initial=0)) + 1
    owner = np.full(4 * len(state) + 2 * reach, -1, np.int32)
    begin, pick = np.zeros(states, np.int32), np.random.default_rng(1)
    for many in np.unique(degree[degree > 0])[::-1].tolist():
        todo = np.flatnonzero(degree == many)
        rows = symbol[first[todo][:, None] + np.arange(many)]
        while len(todo):
            trial = pick.integers(0, len(owner) - reach, len(todo))
            slots = trial[:, None] + rows
            free = np.flatnonzero((owner[slots] < 0).all(1))
            own, wanted = todo[free].astype(np.int32)[:, None], slots[free]
            owner[wanted] = own
            held = owner[wanted] == own
            won = held.all(1)
            owner[wanted[~won][held[~won]]] = -1
            begin[todo[free[won]]] = trial[free[won]]
            rest = np.ones(len(todo), bool)
            rest[free[won]] = False
            todo, rows = todo[rest], rows[rest]
    return begin, begin[state] + symbol, owner


class Parser:
    """The automata of all languages in one table, which has a slot for each transition.

    Every letter that any reference text has is a symbol, so the table grows with the texts and not
    with the alphabets.  Symbols: 0 pads a run and changes nothing, 1 is a separator, 2 a letter that
    no reference text has.
    """

    def __init__(self, model: Model):
        self.names = [name for name, _ in model]
        known = sorted(set("".join(text for _, text in model)) - {" "})
        codes = {c: i + 3 for i, c in enumerate(known)} | {" ": 1}
        kind = np.uint16 if len(known) < 65_000 else np.uint32
        own = np.zeros(0x110000, kind)
        own[[ord(c) for c in known]] = np.arange(3, len(known) + 3)
        own = own[_folded()]
        self.symbols = np.where(own > 0, own, np.where(_folded() > 0, 2, 1)).astype(kind)
        parts, roots, base = [], [], 0
        self.first = np.zeros((len(model), len(known) + 3), np.int32)  # where a new phrase goes
        for number, (_, text) in enumerate(model):
            states = suffix_automaton([codes[c] for c in text])
            many = np.fromiter(map(len, states), np.int64, len(states))
            symbol = np.fromiter((c for s in states for c in s), np.int32, int(many.sum()))
            target = np.fromiter((t for s in states for t in s.values()), np.int32, int(many.sum()))
            parts.append((np.repeat(np.arange(len(states), dtype=np.int32) + base, many), symbol, target + base))
            self.first[number] = base
            self.first[number, symbol[: many[0]]] = target[: many[0]] + base
            roots.append(base)
            base += len(states)
            del states
        self.roots = np.array(roots, np.int32)
        none = np.zeros(0, np.int32)
        state, symbol, target = (np.concatenate([none, *x]) for x in (zip(*parts) if parts else [(), (), ()]))
        self.begin, slots, self.owner = _placed(state, symbol, base)
        self.target = np.zeros(len(self.owner), np.int32)
        self.target[slots] = target
        self.bits = np.array([np.log2(max(2, len(text))) for _, text in model])

    def phrases(self, runs: np.ndarray) -> np.ndarray:
        """Phrases of each run (columns) in each language (rows); ``runs`` has a row per step."""
        roots = self.roots[:, None]
        state = np.repeat(roots, runs.shape[1], 1)
        count = np.zeros(state.shape, np.int32)
        for step in runs:
            slot = self.begin[state] + step
            goes_on = self.owner[slot] == state
            fresh = self.first[:, step]
            ends = ~goes_on & (step > 0)
            # The phrase so far, and a letter the language never has, which is a phrase alone.
            count += ends & (state != roots)
            count += ends & (fresh == roots)
            state = np.where(goes_on, self.target[slot], np.where(ends, fresh, state))
        return count + (state != roots)

    def estimate(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Bits per letter for each document (columns) and language; letters of each document."""
        bits, _, letters = self.estimate_both(block)
        return bits, letters

    def estimate_both(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``estimate``, and between them the bits per letter with the best language of every run."""
        codes = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((block.data & 0xC0) != 0x80)
        first = np.searchsorted(lead, block.offsets)
        symbols = self.symbols[codes]
        kept = np.ones(len(symbols), bool)
        kept[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)
        letters = np.add.reduceat(np.append(symbols > 1, False), first[:-1], dtype=np.int64)
        letters[first[1:] == first[:-1]] = 0
        upto = np.append(0, np.cumsum(kept))
        first, symbols = upto[first], symbols[kept]
        sizes = np.diff(first)
        many = -(-sizes // RUN)
        start = np.repeat(first[:-1] - RUN * (np.cumsum(many) - many), many) + RUN * np.arange(many.sum())
        stop = np.minimum(start + RUN, np.repeat(first[1:], many))
        of = np.repeat(np.arange(block.size), many)
        total, least = np.zeros((len(self.names), block.size)), np.zeros(block.size)
        padded = np.append(symbols, np.zeros(RUN, symbols.dtype))
        order = np.argsort(start - stop, kind="stable")
        for low in range(0, len(order), 4096):
            some = order[low : low + 4096]
            longest = int((stop[some] - start[some]).max())
            steps = np.arange(longest)[:, None]
            runs = padded[start[some][None] + steps]
            runs[steps >= (stop - start)[some][None]] = 0
            counts = self.phrases(runs)
            least += np.bincount(of[some], (counts * self.bits[:, None]).min(0), block.size)
            for language in range(len(self.names)):
                total[language] += np.bincount(of[some], counts[language], block.size)
        many = np.maximum(letters, 1)
        return total * self.bits[:, None] / many, least / many, letters


@lru_cache(2)
def parser(model: Model) -> Parser:
    return Parser(model)


@lru_cache(2)
def limits(model: Model) -> np.ndarray:
    """The most bits a letter of texts of at least each of ``LENGTHS`` letters in a learned language."""
    halves = [[text[: len(text) // 2] for _, text in model], [text[len(text) // 2 :] for _, text in model]]
    found = np.full(len(LENGTHS), np.nan)
    for known, held_out in (halves, halves[::-1]):
        own = Parser(tuple((name, text) for (name, _), text in zip(model, known)))
        for i, size in enumerate(LENGTHS):
            for text in held_out:
                pieces = pa.array([text[at : at + size] for at in range(0, len(text) - size + 1, size)], pa.string())
                needs = [estimates(own, block)[2] for block in blocks(pieces, BLOCK)]
                needs = np.concatenate([np.zeros(0), *needs])
                needs = needs[~np.isnan(needs)]
                if len(needs):
                    found[i] = np.fmax(found[i], np.quantile(needs, 0.9))
    for i in range(len(found)):  # without a piece of that length, the limit of shorter ones
        if np.isnan(found[i]):
            found[i] = found[i - 1] if i else np.inf
    return found * TOLERANCE


def learn(documents: DataFrame) -> Model:
    """Reference text of each language of ``documents(doc_id, text, lang)``, bounded per language.

    Whole documents are drawn by a hash.  Only where a language has none that fits, pieces spread over a
    longer one stand for it.
    """
    texts = documents.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    sizes = texts.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("_many"))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    size = REFERENCE_CHARS // PIECES
    pieces = [
        F.substring("text", F.floor(F.length("text") * F.lit(i) / PIECES).cast("int") + 1, F.lit(size))
        for i in range(PIECES)
    ]
    drawn = (
        texts.join(F.broadcast(sizes) if sizes.count() <= FEW_LANGUAGES else sizes, F.col("lang") == F.col("_lang"))
        .where(place * F.col("_many") <= F.lit(float(SAMPLE_DOCUMENTS) * (1 << 40)))
        .withColumn("too_long", F.length("text") > REFERENCE_CHARS)
        .withColumn("text", F.when(F.col("too_long"), F.concat_ws(" ", *pieces)).otherwise(F.col("text")))
        .select("lang", "too_long", place.alias("place"), "text")
        .orderBy("lang", "too_long", "place", "text")
        .toLocalIterator()
    )
    found: dict[str, str] = {}
    for row in drawn:
        so_far, more = found.get(row.lang, ""), letters_of(row.text)
        if not so_far or len(so_far) + len(more) < REFERENCE_CHARS:
            found[row.lang] = f"{so_far} {more}"
    return tuple(sorted((name, text) for name, text in found.items() if text.strip()))


def estimates(own: Parser, block: Block) -> tuple[np.ndarray, ...]:
    """Number of the best language, score, bits per letter and letters of each document of a block."""
    if not own.names:
        none = np.zeros(block.size, np.int64)
        return none, np.zeros(block.size), np.full(block.size, np.nan), none
    bits, letters = own.estimate(block)
    order = np.sort(bits, 0)
    second = order[1] if len(order) > 1 else np.full(block.size, np.inf)
    some = letters > 0
    return (
        np.where(some, bits.argmin(0), len(own.names)),
        np.where(some, 1 / (1 + order[0] / np.maximum(second, 1e-12)), 0.0),
        np.where(some, order[0], np.nan),
        letters,
    )


def accepted(documents: DataFrame, model: Model, most_bits: float | None = None) -> DataFrame:
    """The documents written in learned languages, each run in its own, with all their columns.

    Rejected are those without a letter, and those whose estimate is over ``most_bits`` bits per
    letter, by default over the limit for their length: no learned language explains their text.
    """
    place = documents.columns.index("text")
    most = limits(model) if most_bits is None else np.full(len(LENGTHS), most_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(model)
        for batch in batches:
            for block in blocks(batch.column(place), BLOCK):
                if not own.names:
                    continue
                _, bits, letters = own.estimate_both(block)
                at = np.maximum(np.searchsorted(LENGTHS, letters, side="right") - 1, 0)
                good = (letters > 0) & (bits <= most[at])
                yield batch.slice(block.first, block.size).filter(pa.array(good))

    return documents.mapInArrow(tidied(run), documents.schema)


def identify(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, bits`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = parser(model)
        names = np.array([*own.names, UNKNOWN], object)
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                best, score, least, _ = estimates(own, block)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.size),
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(score),
                        pa.array(least, from_pandas=True),
                    ],
                    ["doc_id", "lang_pred", "score", "bits"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, bits double"
    )
