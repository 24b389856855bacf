"""N-gram Jaccard join (operator 8): a count-vector R-tree over exact candidate groups.

A document is the set of its distinct shingles of ``shingle`` words.  Two documents link when
``100 * |A & B| >= percent * |A | B|``; the result is the connected component of every document.
Both are parameters: by default ``SHINGLE`` and ``PERCENT``, the contract of the query.

*Who is compared.*  With an order of all shingles, linked sets share one of their first
``n - ceil(n * percent / 100) + 1`` (prefix filter, exact for any order).  Here a shingle comes the
earlier the rarer its rarest word is in the whole corpus, so that common phrases come last.  The
documents that share a prefix shingle form a group, cut where neighbours by size differ too much
for a link; groups of the same documents are one, and copies of one set are represented by one
document.

*How they are compared.*  Shingles are hashed into groups (the more, the larger the set); a
document's counts per group are a point.  The points of a group of documents form an R-tree; the
sum of coordinate minima bounds the overlap of two points, and of any two below two boxes when taken
over the boxes' upper corners.  Pairs that the bound leaves join documents into families, whose sets
are then fetched and verified exactly, again along an R-tree.  Pairs that are connected already are
neither bounded nor verified again, so a family of near copies costs about one verification per
document.  A large family in which few pairs are left is verified star by star, a star being what a
group of documents left connected.  Groups and families of more than about ``TILE`` documents are cut
into tiles by size, and tiles whose sizes allow a link are joined pair by pair, each in a task of its
own.  No link is lost at any step.

Defined results: null, empty and wordless texts have no shingle and link with nothing; fewer words
than a shingle has are one shingle; texts of any length are read whole, the document being the unit of memory;
rows with the same id are one node and each gets its own ``n_shingles``; rows without an id have no
component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.blocks import blocks, lowered, mixed, owners, range_hashes, spread, tidied, values_of, words_of
from fieldpulse.llm.graphs import Forest, components
from fieldpulse.llm.exchange import SORTED_CHARS_PER_TARGET, targets_for
from fieldpulse.session import work_folder

SHINGLE = 3
PERCENT = 90
GROUPS = 64
PER_GROUP = 8
LEAF = 16
TILE = 512
#: Words that make up more than one in so many of all words are told apart by frequency: at most so many.
FREQUENT = 200_000
ROWS_AT_ONCE = 1_000_000
#: Bits, 32 in a row, that tell tasks whose texts to send.
MARKS = 1 << 22


def word_hashes(block) -> tuple[np.ndarray, np.ndarray]:
    data = lowered(block.data)
    words = words_of(data, block.offsets)
    return range_hashes(data, words.starts, words.ends), words.offsets


def shingles_of(
    words: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and document of every shingle, repeats included."""
    sizes = np.diff(offsets)
    of = owners(offsets)
    full = np.flatnonzero((np.arange(len(words)) + shingle <= offsets[1:][of]) if len(words) else np.zeros(0, bool))
    hashes = np.zeros(len(full), np.uint64)
    for i in range(shingle):
        hashes = mixed(hashes * np.uint64(0xD1342543DE82EF95) + words[full + i] + np.uint64(i + 1))
    short = np.flatnonzero((sizes > 0) & (sizes < shingle))
    alone = np.zeros(len(short), np.uint64)
    for i in range(shingle - 1):
        more = sizes[short] > i
        alone[more] = mixed(alone[more] * np.uint64(0xD1342543DE82EF95) + words[offsets[:-1][short[more]] + i] + np.uint64(i + 1))
    alone = mixed(alone + sizes[short].astype(np.uint64))
    return np.append(hashes, alone), np.append(full, offsets[:-1][short]), np.append(of[full], short)


def sets_of(words: np.ndarray, offsets: np.ndarray, classes: np.ndarray | None = None, shingle: int = SHINGLE):
    """Distinct shingles of each document in the order of rarity, and where each document starts.

    ``classes`` has the frequency class of every word; the class of a shingle is its rarest word's.
    """
    hashes, first, of = shingles_of(words, offsets, shingle)
    place = hashes >> np.uint64(6)
    if classes is not None:
        last = offsets[1:][of] - 1
        rarest = classes[first]
        for i in range(1, shingle):
            rarest = np.minimum(rarest, classes[np.minimum(first + i, last)])
        place = place | (rarest.astype(np.uint64) << np.uint64(58))
    order = np.argsort(place, kind="stable")
    order = order[np.argsort(of[order].astype(np.uint32), kind="stable")]
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.searchsorted(of[new], np.arange(len(offsets)))


def prefix_size(n, percent: int = PERCENT):
    return n - -(-n * percent // 100) + 1


# -- word frequencies -----------------------------------------------------------------------------


def frequent_words(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the frequent words of the whole corpus, sorted, and their frequency classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, held = np.zeros(0, np.uint64), np.zeros(0, np.int64), []

        def merged():
            every = np.concatenate([known, *held])
            words, which = np.unique(every, return_inverse=True)
            weights = np.ones(len(every))
            weights[: len(known)] = counts
            return words, np.bincount(which, weights, len(words)).astype(np.int64)

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(known.view(np.int64)), pa.array(counts)], ["word", "n"])

        for batch in batches:
            for block in blocks(batch.column(0)):
                held.append(word_hashes(block)[0])
                if sum(map(len, held)) > ROWS_AT_ONCE:
                    known, counts = merged()
                    held = []
                    if len(known) > ROWS_AT_ONCE:
                        yield batch_of()
                        known, counts = known[:0], counts[:0]
        known, counts = merged()
        yield batch_of()

    spark = documents.sparkSession
    folder = work_folder(spark, "words")
    counted = documents.select("text").mapInArrow(tidied(count), "word long, n long")
    counted.groupBy("word").agg(F.sum("n").alias("n")).write.parquet(folder)
    table = spark.read.parquet(folder)
    total = table.agg(F.sum("n")).first()[0] or 0
    least = max(2, total // FREQUENT + 1)
    rows = table.where(F.col("n") >= least).toPandas()
    words = rows["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    classes = 1 + np.log2(rows["n"].to_numpy(np.float64) / least)
    return words[order], np.minimum(classes, 60).astype(np.uint8)[order]


def classes_of(words: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, classes = frequent
    if not len(known):
        return np.zeros(len(words), np.uint8)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, classes[at], 0).astype(np.uint8)


# -- candidates -----------------------------------------------------------------------------------

_ENTRY = np.dtype([("token", "<u8"), ("doc", "<i8"), ("size", "<i4")])


def _sets_and_candidates(documents: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Rows of two kinds in one table: documents ``(doc, size, one, two, points)``, and the members
    ``(doc, size, job, many)`` of groups that share a shingle."""
    spark = documents.sparkSession
    targets = targets_for(documents, share=SORTED_CHARS_PER_TARGET)
    shared = spark.sparkContext.broadcast(frequent_words(documents))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, seen = [], 0, {}

        def flush() -> pa.RecordBatch:
            entries = np.concatenate(held)
            held.clear()
            target = (mixed(entries["token"]) % np.uint64(targets)).astype(np.int64)
            order = np.argsort(target, kind="stable")
            cuts = np.searchsorted(target[order], np.arange(targets + 1))
            some = [t for t in range(targets) if cuts[t] < cuts[t + 1]]
            raw = [entries[order[cuts[t] : cuts[t + 1]]].tobytes() for t in some]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()), pa.array(raw, pa.binary()), *[pa.nulls(len(some), k) for k in kinds]], names
            )

        for batch in batches:
            docs = batch.column(0)
            numbers, known = docs.fill_null(-1).to_numpy(), docs.is_valid().to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1)):
                words, offsets = word_hashes(block)
                hashes, first = sets_of(words, offsets, classes_of(words, shared.value), shingle)
                sizes = np.diff(first)
                one = np.add.reduceat(np.append(mixed(hashes), np.uint64(0)), first[:-1])
                two = np.add.reduceat(np.append(mixed(hashes ^ np.uint64(0xABCDEF12345)), np.uint64(0)), first[:-1])
                one[sizes == 0] = two[sizes == 0] = 0
                own = slice(block.first, block.first + block.size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((np.arange(block.size) % targets).astype(np.int32)),
                        pa.nulls(block.size, pa.binary()),
                        docs[own],
                        pa.array(sizes.astype(np.int64)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array(points_of(hashes, first), pa.binary()),
                    ],
                    names,
                )
                # Copies of a set that this task has sent already are represented by it.
                fresh = np.zeros(block.size, bool)
                for i in np.flatnonzero((sizes > 0) & known[own]).tolist():
                    key = (int(one[i]), int(two[i]))
                    if len(seen) < ROWS_AT_ONCE or key in seen:
                        fresh[i] = key not in seen
                        seen[key] = True
                    else:
                        fresh[i] = True
                prefix = np.where(fresh, prefix_size(sizes, percent), 0)
                at = np.repeat(first[:-1] - np.cumsum(prefix) + prefix, prefix) + np.arange(prefix.sum())
                entries = np.zeros(len(at), _ENTRY)
                entries["token"] = hashes[at]
                entries["doc"] = np.repeat(numbers[own], prefix)
                entries["size"] = np.repeat(sizes, prefix)
                held.append(entries)
                many += len(entries)
                if many > ROWS_AT_ONCE // 2:
                    yield flush()
                    many = 0
        if many:
            yield flush()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.zeros(0, _ENTRY)]
        for batch in batches:
            packed = batch.column(1)
            parts += [np.frombuffer(x, _ENTRY) for x in values_of(packed)]
            rows = batch.filter(packed.is_null())
            none = [pa.nulls(rows.num_rows, pa.int64()), pa.nulls(rows.num_rows, pa.int32())]
            yield pa.RecordBatch.from_arrays([*rows.columns[2:], *none], found)
        parts = [np.concatenate(parts)]  # what was read goes before the sort, and is then the sort's own
        job, doc, size, many = groups_of(parts.pop(), percent)
        gone = pa.nulls(len(job), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc),
                pa.array(size.astype(np.int64)),
                gone,
                gone,
                pa.nulls(len(job), pa.binary()),
                pa.array(job.view(np.int64)),
                pa.array(many.astype(np.int32)),
            ],
            found,
        )

    kinds = [pa.int64()] * 4 + [pa.binary()]
    names = ["target", "packed", "doc", "size", "one", "two", "points"]
    found = ["doc", "size", "one", "two", "points", "job", "many"]
    rows = documents.select(F.col("doc_id").cast("long").alias("doc"), "text")
    row = "doc long, size long, one long, two long, points binary"
    sent = rows.mapInArrow(tidied(send), f"target int, packed binary, {row}")
    folder = work_folder(spark, "near_sets")
    dealt = sent.repartitionById(targets, F.col("target"))
    dealt.mapInArrow(tidied(resolve), f"{row}, job long, many int").write.parquet(folder)
    return spark.read.parquet(folder)


def groups_of(
    entries: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group, document, its size and the group's for all groups of documents that share a token.

    A group ends where the next larger document is too large for a link.
    """
    entries = entries[np.lexsort((entries["doc"], entries["size"], entries["token"]))]
    twice = np.zeros(len(entries), bool)
    low, high = entries[:-1], entries[1:]
    same = low["token"] == high["token"]
    twice[1:] = same & (low["doc"] == high["doc"]) & (low["size"] == high["size"])
    new = np.ones(len(entries), bool)
    new[1:] = ~(same & (low["size"].astype(np.int64) * 100 >= high["size"].astype(np.int64) * percent))
    group = np.cumsum(new) - 1
    entries, group = entries[~twice], group[~twice]
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    many = np.diff(np.append(cuts, len(group)))
    names = mixed(np.add.reduceat(mixed(entries["doc"].view(np.uint64)), cuts)) if len(cuts) else np.zeros(0, np.uint64)
    names = names + many.astype(np.uint64)
    _, first = np.unique(names, return_index=True)
    first = first[many[first] > 1]
    at = spread(cuts[first], many[first])
    return np.repeat(names[first], many[first]), entries["doc"][at], entries["size"][at], np.repeat(many[first], many[first])


# -- the R-tree join of a tile or two -----------------------------------------------------------------


def points_of(hashes: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Counts per hash group of each set; sets of more than ``GROUPS * PER_GROUP`` have more groups.

    The first byte of a point tells how many bytes a count has.
    """
    sizes = np.diff(first)
    doublings = np.ceil(np.log2(np.maximum(sizes, 1) / (GROUPS * PER_GROUP))).clip(0).astype(np.int64)
    wide = GROUPS << doublings
    base = np.cumsum(wide) - wide
    of = owners(first)
    group = (hashes & (wide[of] - 1).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(base[of] + group, minlength=int(wide.sum()))
    kinds = (np.uint8,) if counts.max(initial=0) < 256 else (np.uint8, np.uint16, np.uint32)
    raw = {k: counts.astype(k).tobytes() for k in kinds}
    found = []
    for a, b in zip(base.tolist(), wide.tolist()):
        kind = kinds[0] if len(kinds) == 1 else np.min_scalar_type(counts[a : a + b].max()).type
        size = np.dtype(kind).itemsize
        found.append(bytes([size]) + raw[kind][size * a : size * (a + b)])
    return found


def folded(points: list[bytes]) -> np.ndarray:
    """Points as rows, folded to the smallest number of groups among them."""
    least = min(((len(p) - 1) // p[0] for p in points), default=0)
    rows = [np.frombuffer(p, f"u{p[0]}", offset=1).reshape(-1, least).sum(0) for p in points]
    return np.array(rows, np.int32)


class CountTree:
    """Points of counts per group, packed into boxes by size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.sizes = sizes
        self.order = np.argsort(sizes, kind="stable")
        self.points = points[self.order]
        cuts = np.arange(0, len(sizes), LEAF)
        self.upper = np.maximum.reduceat(self.points, cuts) if len(sizes) else self.points
        self.least = self.sizes[self.order][cuts]

    def leaf(self, number: int) -> np.ndarray:
        return self.order[number * LEAF : (number + 1) * LEAF]


def needed(one, two, percent: int = PERCENT):
    """The overlap two sets of these sizes need: ``100 o >= percent (one + two - o)``."""
    return -(-(one + two) * percent // (100 + percent))


def linked(one: np.ndarray, two: np.ndarray, percent: int = PERCENT) -> bool:
    """Exact check on two sorted sets."""
    if len(one) > len(two):
        one, two = two, one
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    return int((two[at] == one).sum()) >= needed(len(one), len(two), percent)


def tree_links(
    points: list[bytes],
    sizes: list[int],
    docs: list[int],
    side: np.ndarray | None = None,
    sets: list | None = None,
    percent: int = PERCENT,
) -> list[tuple[int, int]]:
    """Links that connect what is connected among documents, or between those of side 0 and side 1.

    A pair links if the bound allows it and, where ``sets`` are given, if they do.  A link between
    documents that earlier links connect is not looked for.
    """
    forest = Forest()
    every, size = folded(points), np.array(sizes, np.int64)
    which = [np.arange(len(docs))] if side is None else [np.flatnonzero(side == 0), np.flatnonzero(side == 1)]
    if not all(map(len, which)):
        return []
    trees = [CountTree(every[w], size[w]) for w in which]
    left, right, mine, other = trees[0], trees[-1], which[0], which[-1]
    for a in range(len(left.upper)):
        bound = np.minimum(left.upper[a], right.upper).sum(1)
        close = bound >= needed(left.least[a], right.least, percent)
        if side is None:
            close[:a] = False
        for b in np.flatnonzero(close).tolist():
            rows, columns = left.leaf(a), right.leaf(b)
            own = left.points[a * LEAF : a * LEAF + len(rows)]
            shared = np.minimum(own[:, None], right.points[None, b * LEAF : b * LEAF + len(columns)]).sum(2)
            good = shared >= needed(left.sizes[rows][:, None], right.sizes[columns][None], percent)
            for i, j in zip(*(x.tolist() for x in np.nonzero(good))):
                one, two = int(mine[rows[i]]), int(other[columns[j]])
                if one != two and forest.root(docs[one]) != forest.root(docs[two]):
                    if sets is None or linked(sets[one], sets[two], percent):
                        forest.join(docs[one], docs[two])
    return forest.stars()


def _tiled(members: DataFrame, percent: int) -> DataFrame:
    """Jobs ``cluster, one, two, doc, side`` for clusters of any size, cut into tiles by size.

    A tile is joined with itself (``one = two``) and with each other tile whose sizes allow a link.
    """
    by_size = members.groupBy("cluster", "size").agg(F.count("*").alias("n"))
    before = F.sum("n").over(
        Window.partitionBy("cluster").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    )
    steps = by_size.select(
        "cluster",
        "size",
        F.floor(F.coalesce(before, F.lit(0)) / TILE).alias("step"),
        F.ceil(F.col("n") / TILE).alias("splits"),
    )
    split = F.pmod(F.xxhash64("doc"), F.col("splits")).alias("split")
    tiled = members.join(steps, ["cluster", "size"]).withColumn("tile", F.struct("step", split))
    boxes = tiled.groupBy("cluster", "tile").agg(F.min("size").alias("low"), F.max("size").alias("high"))
    other = boxes.select("cluster", *[F.col(c).alias(f"other_{c}") for c in ("tile", "low", "high")])
    pairs = boxes.join(other, "cluster").where(
        (F.col("tile") < F.col("other_tile"))
        & (F.least("high", "other_high") * 100 >= F.greatest("low", "other_low") * percent)
    )
    pairs = pairs.select("cluster", F.col("tile").alias("one"), F.col("other_tile").alias("two"))

    def side(number: int, name: str) -> DataFrame:
        joined = tiled.withColumnRenamed("tile", name).join(pairs, ["cluster", name])
        return joined.select("cluster", "one", "two", "doc", F.lit(number).alias("side"))

    alone = tiled.select("cluster", F.col("tile").alias("one"), F.col("tile").alias("two"), "doc", F.lit(0).alias("side"))
    return alone.unionByName(side(0, "one")).unionByName(side(1, "two"))


def _jobs(members: DataFrame, percent: int) -> DataFrame:
    """``job, doc, side, alone`` of the members of clusters; only large ones are cut into tiles."""
    small = members.where(F.col("many") <= TILE).select(
        F.col("cluster").alias("job"), "doc", F.lit(0).alias("side"), F.lit(True).alias("alone")
    )
    large = _tiled(members.where(F.col("many") > TILE), percent).select(
        F.xxhash64("cluster", "one", "two").alias("job"),
        "doc",
        "side",
        (F.col("one") == F.col("two")).alias("alone"),
    )
    return small.unionByName(large)


def _solved(rows: DataFrame, solve) -> DataFrame:
    """Links ``a, b`` that ``solve(table of one job)`` finds; rows of a job stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            jobs = rest.column("job").to_numpy()
            last = int(np.searchsorted(jobs, jobs[-1])) if len(jobs) else 0
            if last:
                yield solved(rest.slice(0, last))
                rest = rest.slice(last)
        if rest is not None and len(rest):
            yield solved(rest)

    def solved(table: pa.Table) -> pa.RecordBatch:
        jobs = table.column("job").to_numpy()
        cuts = [0, *(np.flatnonzero(jobs[1:] != jobs[:-1]) + 1).tolist(), len(jobs)]
        found = [link for a, b in zip(cuts, cuts[1:]) for link in solve(table.slice(a, b - a))]
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.repartition("job").sortWithinPartitions("job").mapInArrow(tidied(run), "a long, b long")


def _side(table: pa.Table) -> np.ndarray | None:
    return None if table.column("alone")[0].as_py() else table.column("side").to_numpy()


def _possible(points: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs that the bound on their points allows, as stars of each job."""

    def solve(table: pa.Table) -> list[tuple[int, int]]:
        docs, sizes = table.column("doc").to_pylist(), table.column("size").to_pylist()
        own = table.column("points").to_pylist()
        if len(docs) == 2:  # most groups
            if docs[0] == docs[1] or needed(*sizes, percent) > np.minimum(*folded(own)).sum():
                return []
            return [(max(docs), min(docs))]
        return tree_links(own, sizes, docs, _side(table), percent=percent)

    return _solved(_jobs(members, percent).join(points, "doc"), solve)


def _families(possible: DataFrame, components: DataFrame) -> DataFrame:
    """``cluster, doc, many``: sets of documents, such that each possible pair is inside one of them.

    That is a component of the possible pairs or, where these are sparse in a large one, each star of
    it: both ends of a possible pair are in the star of their job.  Which of the two is taken is the
    number of rows that :func:`_jobs` makes of them at most.
    """
    named = components.select(F.col("node").alias("doc"), "component")
    whole = named.join(named.groupBy("component").agg(F.count("*").alias("many")), "component")
    large = whole.where(F.col("many") > TILE)
    stars = possible.join(large.withColumnRenamed("doc", "a"), "a").select(
        "component", "many", F.col("b").alias("cluster"), F.explode(F.array("a", "b")).alias("doc")
    )
    stars = stars.distinct()

    def rows(many: str) -> Column:
        return F.col(many) * F.ceil(F.col(many) / TILE)

    sizes = stars.groupBy("component", "many", "cluster").agg(F.count("*").alias("own"))
    costs = sizes.groupBy("component", "many").agg(F.sum(rows("own")).alias("cost"))
    sparse = costs.where(F.col("cost") < rows("many")).select("component")
    parts = stars.join(sparse, "component", "left_semi").join(sizes.select("cluster", "own"), "cluster")
    return (
        whole.join(sparse, "component", "left_anti")
        .select(F.col("component").alias("cluster"), "doc", "many")
        .unionByName(parts.select("cluster", "doc", F.col("own").alias("many")))
    )


def _mostly(texts: DataFrame, members: DataFrame) -> DataFrame:
    """All texts of members and few others, which then need not be shuffled.

    Members are marked in ``MARKS`` bits, a bound that does not grow, by a hash of their id.
    """
    mark = F.pmod(F.xxhash64("doc"), F.lit(MARKS))
    place = F.floor(mark / 32).alias("place")
    bit = F.pow(F.lit(2), F.pmod(mark, F.lit(32))).cast("long").alias("bit")
    marks = members.select(place, bit).groupBy("place").agg(F.bit_or("bit").alias("marks"))
    marked = texts.select("*", place, bit).join(F.broadcast(marks), "place")
    return marked.where(F.col("marks").bitwiseAND(F.col("bit")) != 0).select(*texts.columns)


def _links(documents: DataFrame, members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Verified links within clusters, as stars of each job."""

    def solve(table: pa.Table) -> list[tuple[int, int]]:
        sets, points = [], []
        for block in blocks(table.column("text").combine_chunks()):
            hashes, first = sets_of(*word_hashes(block), shingle=shingle)
            ends = first.tolist()
            sets += [np.sort(hashes[a:b]) for a, b in zip(ends, ends[1:])]
            points += points_of(hashes, first)
        sizes, docs = list(map(len, sets)), table.column("doc").to_pylist()
        return tree_links(points, sizes, docs, _side(table), sets, percent)

    texts = _mostly(documents.select(F.col("doc_id").cast("long").alias("doc"), "text"), members)
    return _solved(texts.join(_jobs(members, percent).hint("shuffle_hash"), "doc"), solve)


def near_components(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``documents``."""
    rows = _sets_and_candidates(documents, shingle, percent)
    sets = rows.where("job is null")
    known = sets.where("doc is not null and size > 0")
    same = ["size", "one", "two"]
    # Written, so that the join has a shuffle of its own on either side and can split a hot set.
    folder = work_folder(documents.sparkSession, "near_copies")
    first = known.groupBy(*same).agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first.where("first != last").select(*same, "first").write.parquet(f"{folder}/first")
    first = documents.sparkSession.read.parquet(f"{folder}/first")
    copies = known.join(first, same).where("doc != first").select("doc", "first").distinct()

    def represented(edges: DataFrame, column: str) -> DataFrame:
        other = copies.select(F.col("doc").alias(column), F.col("first").alias(f"{column}_first"))
        joined = edges.join(other, column, "left")
        return joined.withColumn(column, F.coalesce(f"{column}_first", column)).drop(f"{column}_first")

    groups = rows.where("job is not null").select(F.col("job").alias("cluster"), "doc", "size", "many").distinct()
    possible = _possible(known.select("doc", "size", "points").distinct(), groups, percent)
    represented(represented(possible, "a"), "b").where("a != b").distinct().write.parquet(f"{folder}/possible")
    possible = documents.sparkSession.read.parquet(f"{folder}/possible")
    sized = _families(possible, components(possible))
    members = sized.join(known.select("doc", "size").distinct(), "doc").select("cluster", "doc", "size", "many")
    members.write.parquet(f"{folder}/members")
    members = documents.sparkSession.read.parquet(f"{folder}/members")
    links = _links(documents, members, shingle, percent).unionByName(copies.select(F.col("doc").alias("a"), F.col("first").alias("b")))
    found = components(links).withColumnsRenamed({"node": "doc"})
    return sets.join(found, "doc", "left").select(
        F.col("doc").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )


def representatives(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The smallest document of each component, and rows without an id, with all their columns."""
    kept = near_components(documents, shingle, percent).where("doc_id = component_id").select("doc_id").distinct()
    known = documents.where("doc_id is not null").join(kept.hint("shuffle_hash"), "doc_id", "left_semi")
    return known.unionByName(documents.where("doc_id is null")).select(*documents.columns)
