"""Phrase collocation mining (operator 11): weighted acyclic automata over words.

A shard is some two million words.  Its word sequences of up to three words, sorted, become an acyclic
automaton: a path of words leads to a state, and the state's weight is how often the path occurs.  It is
built from the sorted paths one after the other, a path adding states from where it leaves its
predecessor's.  Each shard's automaton is cut into prefix ranges, the same for all shards, and a task
per range unites what the shards have of it, summing the weights of equal paths.  Ranges are cut at
quantiles of a sample, inside the paths of a frequent word or pair too, so no task gathers such a word;
the weights of the few prefixes that a cut divides are summed up afterwards.  The sample decides only
where ranges end.

Paths of at least ``least`` occurrences are kept; every part of such a path occurs as often, so nothing
that is looked up is lost.  The parts of a phrase are looked up by composition: the phrases, turned so
that the part looked up comes first, form an automaton of their own, and where both are in the order
of their paths one walk advances in both.  Prefixes that many phrases share are not gathered: their
weights travel beside the rows.

A word's symbol is a 63-bit hash of language and word, so paths of different languages never meet; two
words get the same symbol with a chance of 2^-63 a pair.

Defined results: null and empty texts have no words; a null language is ``und`` and one with it; texts
of any length are counted whole; equal rows and repeated ids all count; ties of score go to the more
frequent phrase, then to the smaller one in bytes, so ranks are unique; an empty table gives no rows;
columns other than text and language are not read.  Counts stay below 10^15, for which scores are exact.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import Block, blocks, lowered, mixed, owners, range_hashes, spread
from fieldpulse.session import work_folder

#: Words of a shard; local numbers of words take 21 bits.
SHARD_WORDS = 2_000_000
#: Characters of text whose paths one range holds.
CHARS_PER_RANGE = 12 << 20
#: Sampled words per range, by which the ranges are cut.
SAMPLED_PER_RANGE = 128
#: Requests that a prefix may gather in one task, at least.
LEAST_SHARE = 1000
#: Groups in which the phrases of a language are ranked before they are ranked together.
DEALS = 32
UNKNOWN_LANGUAGE = "und"

_BITS = 21
_MASK = (1 << _BITS) - 1
_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _PIECE_ENDS.copy()
_OUTSIDE[[0x20, 0x09]] = True

Path = tuple[int, int, int]


# -- words -------------------------------------------------------------------------------------


@dataclass
class PlacedWords:
    """Words of a block: symbols, whether the next word is in the same piece, and what they are."""

    symbols: np.ndarray
    joined: np.ndarray
    distinct: np.ndarray
    language: np.ndarray
    sizes: np.ndarray
    data: np.ndarray


def language_hash(name: str) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")


def placed_words(block: Block, language: np.ndarray, hashes: np.ndarray) -> PlacedWords:
    """``language`` numbers the language of each document, ``hashes`` has a hash for each number."""
    data = lowered(block.data)
    outside = _OUTSIDE[data]
    filled = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
    starts, ends = ~outside, ~outside
    starts[1:] &= outside[:-1]
    starts[filled] = ~outside[filled]
    ends[:-1] &= outside[1:]
    ends[filled[1:] - 1] = ~outside[filled[1:] - 1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    document = owners(np.searchsorted(starts, block.offsets))
    own = language[document]
    symbols = (mixed(range_hashes(data, starts, ends) ^ hashes[own]) >> np.uint64(1)).astype(np.int64)
    symbols[symbols == 0] = 1
    piece = np.cumsum(_PIECE_ENDS[data])[starts] if len(starts) else starts
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (piece[1:] == piece[:-1]) & (document[1:] == document[:-1])
    distinct, where = np.unique(symbols, return_index=True)
    sizes = (ends - starts)[where]
    return PlacedWords(symbols, joined, distinct, own[where], sizes, data[spread(starts[where], sizes)])


# -- automata ----------------------------------------------------------------------------------


@dataclass
class Automaton:
    """States by level: a symbol, a weight, and on the first two levels the number of next states.

    States of a level are in the order of their paths.  ``language``, ``sizes`` and ``data`` spell the
    words of the first level.
    """

    symbols: list[np.ndarray]
    weights: list[np.ndarray]
    degrees: list[np.ndarray]
    language: np.ndarray
    sizes: np.ndarray
    data: np.ndarray

    @classmethod
    def built(cls, paths: list[np.ndarray], counts: np.ndarray) -> Automaton:
        """From distinct sorted paths (three symbols, 0 after the end) and their counts."""
        leaves = np.zeros(len(counts), bool)
        leaves[0] = True
        symbols, weights, heads = [], [], []
        for own in paths:
            leaves = leaves.copy()
            leaves[1:] |= own[1:] != own[:-1]
            at = np.flatnonzero(leaves)
            real = own[at] != 0
            symbols.append(own[at][real])
            weights.append(np.add.reduceat(counts, at)[real])
            heads.append(at[real])
        degrees = [
            np.diff(np.append(np.searchsorted(after, before), len(after))) for before, after in zip(heads, heads[1:])
        ]
        none = np.zeros(0, np.int64)
        return cls(symbols, weights, degrees, none, none, np.zeros(0, np.uint8))

    def packed(self, languages: list[str]) -> bytes:
        def small(values: np.ndarray) -> np.ndarray:
            return values.astype(np.min_scalar_type(int(values.max(initial=0))))

        spelled = small(self.language), small(self.sizes), self.data
        return pickle.dumps(
            (self.symbols, [small(w) for w in self.weights], [small(d) for d in self.degrees], *spelled, languages), 5
        )

    @classmethod
    def unpacked(cls, stored: bytes, numbers: dict[str, int]) -> Automaton:
        """``numbers`` numbers the languages of all automata of a task; new ones are added to it."""
        symbols, weights, degrees, language, sizes, data, names = pickle.loads(stored)
        renumber = np.array([numbers.setdefault(n, len(numbers)) for n in names], np.int64)
        return cls(
            symbols, [w.astype(np.int64) for w in weights], [d.astype(np.int64) for d in degrees],
            renumber[language], sizes.astype(np.int64), data,
        )


def united(parts: Sequence[Automaton]) -> tuple[Automaton, np.ndarray, np.ndarray]:
    """All paths of some automata, weights of equal paths summed; parents on levels two and three."""
    def level(i: int) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([p.symbols[i] for p in parts]), np.concatenate([p.weights[i] for p in parts])

    def summed(weights: np.ndarray, state: np.ndarray, count: int) -> np.ndarray:
        return np.bincount(state, weights, count).astype(np.int64)

    first, weights = level(0)
    symbols, where, state = np.unique(first, return_index=True, return_inverse=True)
    sizes = np.concatenate([p.sizes for p in parts])
    starts = (np.cumsum(sizes) - sizes)[where]
    data = np.concatenate([p.data for p in parts])[spread(starts, sizes[where])]
    all_symbols, all_weights, all_degrees, parents = [symbols], [summed(weights, state, len(symbols))], [], []
    for i in (1, 2):
        own, weights = level(i)
        above = np.repeat(state, np.concatenate([p.degrees[i - 1] for p in parts]))
        names, number = np.unique(own, return_inverse=True)
        keys, state = np.unique(above * max(1, len(names)) + number, return_inverse=True)
        parent = keys // max(1, len(names))
        all_symbols.append(names[keys % max(1, len(names))] if len(keys) else own)
        all_weights.append(summed(weights, state, len(keys)))
        all_degrees.append(np.bincount(parent, minlength=len(all_symbols[i - 1])))
        parents.append(parent)
    language = np.concatenate([p.language for p in parts])[where]
    return Automaton(all_symbols, all_weights, all_degrees, language, sizes[where], data), *parents


# -- shards ------------------------------------------------------------------------------------


@dataclass
class Shard:
    """Words that wait for their automata."""

    languages: list[str] = field(default_factory=list)
    blocks: list[PlacedWords] = field(default_factory=list)
    words: int = 0
    numbers: dict[str, int] = field(default_factory=dict)

    def add(self, block: Block, names: list[str | None]) -> None:
        for name in set(names):
            if (name := UNKNOWN_LANGUAGE if name is None else name) not in self.numbers:
                self.numbers[name] = len(self.languages)
                self.languages.append(name)
        hashes = np.array([language_hash(n) for n in self.languages], np.uint64)
        numbers = np.array([self.numbers[UNKNOWN_LANGUAGE if n is None else n] for n in names], np.int64)
        self.blocks.append(placed := placed_words(block, numbers, hashes))
        self.words += len(placed.symbols)

    def paths(self) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
        """Sorted distinct paths with their counts, and the keys and symbols they are made of."""
        symbols = np.concatenate([b.symbols for b in self.blocks])
        joined = np.concatenate([b.joined for b in self.blocks])
        for low in range(0, len(symbols), SHARD_WORDS):
            high = min(low + SHARD_WORDS, len(symbols))
            names, number = np.unique(symbols[low : high + 2], return_inverse=True)
            number = np.append(number + 1, [0, 0])
            size = high - low
            one = joined[low:high]
            two = one & np.append(joined[low + 1 : high + 1], False)[:size]
            keys = number[:size] << 2 * _BITS
            keys |= np.where(one, number[1 : size + 1], 0) << _BITS
            keys |= np.where(two, number[2 : size + 2], 0)
            keys.sort()
            heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(np.append(heads, size))
            keys = keys[heads]
            names = np.append(0, names)
            paths = [names[(keys >> shift) & _MASK] for shift in (2 * _BITS, _BITS, 0)]
            yield paths, counts, keys

    def automata(self, cuts: list[Path]) -> Iterator[tuple[int, Automaton]]:
        """The automaton of each prefix range that has paths, with the range's number."""
        names, where = np.unique(np.concatenate([b.distinct for b in self.blocks]), return_index=True)
        language = np.concatenate([b.language for b in self.blocks])[where]
        sizes = np.concatenate([b.sizes for b in self.blocks])
        starts, sizes = (np.cumsum(sizes) - sizes)[where], sizes[where]
        data = np.concatenate([b.data for b in self.blocks])
        for paths, counts, keys in self.paths():
            ends = [0, *_places(cuts, paths, keys), len(counts)]
            for number, (low, high) in enumerate(zip(ends, ends[1:])):
                if low < high:
                    made = Automaton.built([p[low:high] for p in paths], counts[low:high])
                    at = np.searchsorted(names, made.symbols[0])
                    made.language, made.sizes = language[at], sizes[at]
                    made.data = data[spread(starts[at], sizes[at])]
                    yield number, made


def _places(cuts: list[Path], paths: list[np.ndarray], keys: np.ndarray) -> list[int]:
    """For each cut, the number of sorted paths that come before it."""
    found = []
    for cut in cuts:
        low, high = 0, len(keys)
        for own, symbol in zip(paths, cut):
            low, high = (low + np.searchsorted(own[low:high], [symbol, symbol + 1])).tolist()
            if low == high:
                break
        found.append(low)
    return found


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    """Texts and languages in shards of whole blocks."""
    shard = Shard()
    for batch in batches:
        names = batch.column(1).to_pylist()
        for block in blocks(batch.column(0)):
            shard.add(block, names[block.first : block.first + block.size])
            if shard.words >= SHARD_WORDS:
                yield shard
                shard = Shard()
    if shard.words:
        yield shard


# -- counting ----------------------------------------------------------------------------------


def _cuts(texts: DataFrame, ranges: int, chars: int) -> list[Path]:
    """Paths that divide all paths into about equal ranges, from a sample spread over all texts.

    Spark sorts the sample, and of its sorted paths every so-manieth is a cut, so the driver gets about
    one path per range.
    """
    if ranges == 1:
        return []
    wanted = ranges * SAMPLED_PER_RANGE
    every = max(1, chars // (wanted * 256))  # rows, so that some 40 times as many words are looked at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for paths, _, _ in shard.paths():
                mix = mixed(np.bitwise_xor.reduce([p.view(np.uint64) * np.uint64(2 * i + 3) for i, p in enumerate(paths)]))
                some = mix % np.uint64(16) == 0
                yield pa.RecordBatch.from_arrays([pa.array(p[some]) for p in paths], ["s1", "s2", "s3"])

    chosen = texts.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0) if every > 1 else texts
    folder = work_folder(texts.sparkSession, "phrase_sample")
    chosen.mapInArrow(run, "s1 long, s2 long, s3 long").write.parquet(folder)
    sample = texts.sparkSession.read.parquet(folder)
    step = max(1, sample.count() // ranges)

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = step // 2
        for batch in batches:
            places = np.arange(-seen % step, batch.num_rows, step)
            seen += batch.num_rows
            yield batch.take(pa.array(places))

    in_order = sample.repartitionByRange("s1", "s2", "s3").sortWithinPartitions("s1", "s2", "s3")
    found = in_order.mapInArrow(thinned, sample.schema).distinct().collect()
    return sorted(tuple(r) for r in found)


def path_counts(documents: DataFrame, least: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``s1, s2, s3`` (0 after the end), ``f``, and for single words ``lang`` and ``word``.

    Paths that occur at least ``least`` times, and per language a row without symbols that counts all words.
    The result is a stored table.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    chars = int(texts.agg(F.sum(F.length("text"))).first()[0] or 0)
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_PER_RANGE))
    shared = spark.sparkContext.broadcast(_cuts(texts, ranges, chars))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            for number, made in shard.automata(shared.value):
                stored = pa.array([made.packed(shard.languages)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), stored], ["range", "automaton"])

    dealt = texts.mapInArrow(shards, "range int, automaton binary")
    gathered = dealt.repartitionById(ranges, "range").sortWithinPartitions("range")

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, stored in _by_range(batches):
            yield from _kept_paths(stored, number, shared.value, least)

    folder = work_folder(spark, "phrase_paths")
    gathered.mapInArrow(unite, "s1 long, s2 long, s3 long, f long, lang string, word string").write.parquet(folder)
    summed = spark.read.parquet(folder).groupBy("s1", "s2", "s3", "lang").agg(
        F.sum("f").alias("f"), F.min("word").alias("word")
    )
    folder = work_folder(spark, "phrase_counts")
    summed.where((F.col("f") >= least) | (F.col("s1") == 0)).write.parquet(folder)
    return spark.read.parquet(folder)


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    number, stored = None, []
    for batch in batches:
        for own, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            if own != number and stored:
                yield number, stored
                stored = []
            number = own
            stored.append(value.as_py())
    if stored:
        yield number, stored


def _kept_paths(stored: list[bytes], number: int, cuts: list[Path], least: int) -> Iterator[pa.RecordBatch]:
    """The frequent paths of a range, those that its ends divide, and the words per language."""
    numbers: dict[str, int] = {}
    made, parent2, parent3 = united([Automaton.unpacked(s, numbers) for s in stored])
    one, two, three = made.symbols
    ends = cuts[max(0, number - 1) : number + 1] if number else cuts[:1]
    above = one[parent2]
    partial1, partial2 = np.zeros(len(one), bool), np.zeros(len(two), bool)
    for cut in ends:
        partial1 |= one == cut[0]
        partial2 |= (above == cut[0]) & (two == cut[1])
    names = list(numbers)
    keep = np.flatnonzero((made.weights[0] >= least) | partial1)
    starts = np.cumsum(made.sizes) - made.sizes
    raw = made.data.tobytes()
    spelled = [raw[a : a + n].decode() for a, n in zip(starts[keep].tolist(), made.sizes[keep].tolist())]
    yield _rows([one[keep]], made.weights[0][keep], [names[i] for i in made.language[keep].tolist()], spelled)
    keep = np.flatnonzero((made.weights[1] >= least) | partial2)
    yield _rows([above[keep], two[keep]], made.weights[1][keep])
    keep = np.flatnonzero(made.weights[2] >= least)
    yield _rows([above[parent3[keep]], two[parent3[keep]], three[keep]], made.weights[2][keep])
    totals = np.bincount(made.language, made.weights[0], len(names)).astype(np.int64)
    yield _rows([], totals, names, [None] * len(names))


def _rows(
    path: list[np.ndarray], weights: np.ndarray, languages: list[str] | None = None, words: list | None = None
) -> pa.RecordBatch:
    size = len(weights)
    symbols = [pa.array(p, pa.int64()) for p in [*path, *[np.zeros(size, np.int64)] * (3 - len(path))]]
    texts = [pa.array(x, pa.string()) if x is not None else pa.nulls(size, pa.string()) for x in (languages, words)]
    return pa.RecordBatch.from_arrays(
        [*symbols, pa.array(weights, pa.int64()), *texts], ["s1", "s2", "s3", "f", "lang", "word"]
    )


# -- parts of phrases --------------------------------------------------------------------------

#: Rows of the walk: a count, or a phrase turned so that some part of it comes first.
_COUNT, _AS_IS, _LAST_TWO, _LAST, _SECOND = range(5)


def _turned() -> Column:
    """Requests of a path: in its own order, and once for each rest that is looked up."""
    def turn(kind: int, *order: str) -> Column:
        symbols = [F.col(s).alias(f"a{i + 1}") for i, s in enumerate(order)]
        return F.struct(F.lit(kind).alias("kind"), *symbols)

    three = [turn(_AS_IS, "s1", "s2", "s3"), turn(_LAST_TWO, "s2", "s3", "s1"), turn(_LAST, "s3", "s1", "s2")]
    two = [turn(_AS_IS, "s1", "s2", "s3"), turn(_SECOND, "s2", "s1", "s3")]
    return F.when(F.col("s3") != 0, F.array(*three)).otherwise(F.array(*two))


def with_parts(counts: DataFrame) -> DataFrame:
    """Each phrase of two or three words with the counts of its parts and its words.

    ``l1, r1`` belong to the cut after the first word, ``l2, r2`` to the one after the second.
    """
    session = counts.sparkSession
    singles = counts.where("s1 != 0 AND s2 = 0")
    pairs = counts.where("s2 != 0 AND s3 = 0")
    requests = counts.where("s2 != 0").select(F.explode(_turned()).alias("q"), "f").select("q.*", "f")
    share = max(LEAST_SHARE, requests.count() // (4 * int(session.conf.get("spark.sql.shuffle.partitions"))))

    # At most four prefixes per partition are beyond the share, so they may travel to all tasks.
    often = requests.groupBy("a1").count().where(F.col("count") > share).select(F.col("a1").alias("s1"))
    known1 = singles.join(F.broadcast(often), "s1").select(
        F.col("s1").alias("a1"), F.col("f").alias("f1"), F.col("lang").alias("lang1"), F.col("word").alias("word1")
    )
    often = requests.groupBy("a1", "a2").count().where(F.col("count") > share)
    often = often.select(F.col("a1").alias("s1"), F.col("a2").alias("s2"))
    known2 = often.join(pairs, ["s1", "s2"], "left").select(
        F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.coalesce("f", F.lit(0)).alias("f2")
    )
    nothing = F.lit(None).cast("string")
    rows = requests.withColumns({"lang": nothing, "word": nothing}).unionByName(
        singles.unionByName(pairs).select(
            F.lit(_COUNT).alias("kind"), F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.col("s3").alias("a3"),
            "f", "lang", "word",
        )
    )
    rows = rows.join(F.broadcast(known1), "a1", "left").join(F.broadcast(known2), ["a1", "a2"], "left")
    deal = F.xxhash64(
        "a1", F.when(F.col("f1").isNotNull(), F.col("a2")), F.when(F.col("f2").isNotNull(), F.col("a3"))
    )
    names = ["kind", "a1", "a2", "a3", "f", "lang", "word", "f1", "lang1", "word1", "f2"]
    dealt = rows.select(deal.alias("deal"), *names).repartition("deal")
    sorted_ = dealt.sortWithinPartitions("deal", "a1", "a2", "kind", "a3").select(*names)
    schema = "kind int, s1 long, s2 long, s3 long, f long, x1 long, x2 long, lang string, word string"
    found = sorted_.mapInArrow(_walk, schema)

    def of(value: str, *kinds: int) -> Column:
        return F.max(F.when(F.col("kind").isin(*kinds), F.col(value)))

    return found.groupBy("s1", "s2", "s3").agg(
        F.max("f").alias("a"), F.max("lang").alias("lang"),
        of("x1", _AS_IS).alias("l1"), F.coalesce(of("x2", _LAST_TWO), of("x1", _SECOND)).alias("r1"),
        of("x2", _AS_IS).alias("l2"), of("x1", _LAST).alias("r2"),
        of("word", _AS_IS).alias("w1"), of("word", _LAST_TWO, _SECOND).alias("w2"), of("word", _LAST).alias("w3"),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Advance along counts and requests in the common order of their paths.

    A state reached by one symbol or two stays current until the path changes, also into the next batch.
    """
    current: list[pa.RecordBatch] = []
    for batch in batches:
        batch = pa.concat_batches([*current, batch])
        kind, a1, a2, a3, f = (batch.column(i).to_numpy() for i in range(5))
        place = np.arange(len(kind))
        single, pair = (kind == _COUNT) & (a2 == 0), (kind == _COUNT) & (a2 != 0)
        at1 = np.maximum.accumulate(np.where(single, place, 0))
        at2 = np.maximum.accumulate(np.where(pair, place, 0))
        in1 = single[at1] & (a1[at1] == a1)
        in2 = pair[at2] & (a1[at2] == a1) & (a2[at2] == a2)
        wanted = np.flatnonzero(kind != _COUNT)
        w1 = _first_of(batch.column("f1"), pa.array(f[at1], mask=~in1)).take(pa.array(wanted))
        w2 = _first_of(batch.column("f2"), pa.array(f[at2], mask=~in2)).take(pa.array(wanted))
        texts = []
        for name in ("lang", "word"):
            here = batch.column(name).take(pa.array(at1, mask=~in1))
            texts.append(_first_of(batch.column(f"{name}1"), here).take(pa.array(wanted)))
        kinds, one, two, three = kind[wanted], a1[wanted], a2[wanted], a3[wanted]
        natural = [
            np.select([kinds == _LAST_TWO, kinds != _AS_IS], [three, two], one),
            np.select([kinds == _LAST_TWO, kinds == _LAST, kinds == _SECOND], [one, three, one], two),
            np.select([kinds == _LAST_TWO, kinds == _LAST], [two, one], three),
        ]
        arrays = [pa.array(kinds), *map(pa.array, natural), pa.array(f[wanted]), w1, w2, *texts]
        yield pa.RecordBatch.from_arrays(arrays, ["kind", "s1", "s2", "s3", "f", "x1", "x2", "lang", "word"])
        if len(place):
            last = sorted({int(at1[-1]), int(at2[-1])})
            current = [batch.slice(i, 1) for i in last if kind[i] == _COUNT]


def _first_of(one: pa.Array, other: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.coalesce(one, other)


# -- phrases -----------------------------------------------------------------------------------


def _score(left: str, right: str) -> Column:
    """floor(1,000,000 a a / (left right)), in decimals wide enough for the products."""
    return F.expr(
        f"CAST(1000000 AS DECIMAL(7,0)) * (CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)))"
        f" DIV (CAST({left} AS DECIMAL(15,0)) * CAST({right} AS DECIMAL(15,0)))"
    )


def scored(counts: DataFrame, inside_percent: int) -> DataFrame:
    """Phrases that no longer one covers, with the lowest-scoring of their cuts."""
    parts = with_parts(counts)
    longer = counts.where("s3 != 0").select(
        F.explode(F.array(F.struct("s1", "s2"), F.struct(F.col("s2").alias("s1"), F.col("s3").alias("s2")))).alias("p"), "f"
    )
    longer = longer.groupBy("p.s1", "p.s2").agg(F.max("f").alias("longest")).withColumn("s3", F.lit(0).cast("long"))
    open_ = parts.join(longer, ["s1", "s2", "s3"], "left").where(
        F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * inside_percent)
    )

    def cut(k: int) -> Column:
        left, right = F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")
        return F.struct(_score(f"l{k}", f"r{k}").alias("score"), F.lit(k).alias("k"), left, right)

    cuts = F.when(F.col("s3") != 0, F.array(cut(1), cut(2))).otherwise(F.array(cut(1)))
    return open_.withColumn("cut", F.array_min(cuts)).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
    )


def collocations(
    documents: DataFrame,
    least: int = 10,
    inside_percent: int = 50,
    top: int = 2000,
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The best ``top`` phrases of each language, with counts of the phrase, its parts and all words."""
    counts = path_counts(documents, least, text_col, lang_col)
    order = F.desc("score"), F.desc("a"), F.asc("phrase")
    deal = F.pmod(F.xxhash64("phrase"), F.lit(DEALS))
    best = scored(counts, inside_percent)
    for by in (["lang", deal], ["lang"]):  # the last ranking sees at most DEALS times top rows of a language
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        best = best.withColumn("rank", place).where(F.col("rank") <= top)
    totals = counts.where("s1 = 0").select("lang", F.col("f").alias("n"))
    names = ["lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"]
    return best.join(totals, "lang").select(*names)
