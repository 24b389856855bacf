"""Embedding near-dedup (operator 9): robust-pruned flat graphs with range-expanding search.

Vectors of equal label and dimension are compared by cosine in double precision.  Equal vectors are
collapsed first and counted, so a vector that a third of all rows share is one node.  Each label is
cut into overlapping shards: k-means centres (fitted on a sample of ``SAMPLE`` vectors over all labels,
or four for each centre if that is more), and every vector joins the shards of its ``overlap`` nearest centres.

In each shard a flat graph is built by robust pruning: of the nearest and some random members a
vector keeps one after the other, dropping those that a kept one is nearer to by ``ALPHA``.  The
adjacency lists of a vector from all its shards are united.  Every vector then searches each of its
shards: a greedy search from the medoid with a beam, and from the vectors found in range on and on
through all neighbours in range.  What is linked was compared exactly; a pair that meets in two
shards is counted in the smaller one.

The graph may miss links, so recall is audited label by label: ``AUDITED`` vectors of each, chosen by
a hash, are compared with all rows, and up to ``MOST_AUDITED`` until ``LINKED`` of them have links.  If
the graphs found on average less than ``RECALL`` of a vector's links, the search is done anew with
more overlap and a wider beam; labels that are short after ``ATTEMPTS`` are compared exactly, in
blocks of ``EXACT`` vectors.

Defined results: a vector that is null, empty, zero or has null or non-finite components, and any
vector without a label, links with nothing; rows with the same id are one node of several vectors,
each row showing the node's links; rows without an id have no links and no component; an empty table
gives no rows; further columns are ignored.  The shards' centres travel with the tasks, one for
``SHARD`` vectors and at most ``CENTRES``; beyond ``SHARD * CENTRES`` different vectors shards grow.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldpulse.llm.graphs import components, spanning
from fieldpulse.session import work_folder

NEAR = 0.98
SHARD = 1_000
CENTRES = 32_768
SAMPLE = 20_000
OVERLAP = 2
DEGREE = 24
NEAREST = 48
STRANGERS = 16
ALPHA = 1.2
BEAM = 24
AUDITED = 200
LINKED = 50
MOST_AUDITED = 12_800
EXACT = 2_000
RECALL = 0.95
ATTEMPTS = 3


# -- one shard ------------------------------------------------------------------------------------


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def robust_prune(near: np.ndarray, between: np.ndarray, most: int) -> list[int]:
    """Positions kept of candidates with distances ``near`` from the vector, ``between`` each other."""
    kept, open_ = [], np.ones(len(near), bool)
    for i in np.argsort(near, kind="stable").tolist():
        if open_[i]:
            kept.append(i)
            if len(kept) == most:
                break
            open_ &= ALPHA * between[i] > near
    return kept


def build_graph(vectors: np.ndarray, seed: int = 5) -> list[list[int]]:
    """Adjacency lists of a shard: pruned candidates and, where there is room, their reverses."""
    size = len(vectors)
    pick = np.random.default_rng(seed)
    lists: list[list[int]] = []
    for low in range(0, size, 512):
        close = vectors[low : low + 512] @ vectors.T
        close[np.arange(len(close)), np.arange(low, low + len(close))] = -2
        many = min(NEAREST, size - 1)
        best = np.argpartition(-close, many - 1, 1)[:, :many] if many else np.zeros((len(close), 0), np.int64)
        for i, candidates in enumerate(best):
            some = np.unique(np.append(candidates, pick.integers(0, size, STRANGERS)))
            some = some[some != low + i]
            own = vectors[some]
            between = 1 - own @ own.T
            lists.append(some[robust_prune(1 - own @ vectors[low + i], between, DEGREE)].tolist())
    known = [set(x) for x in lists]
    for i, own in enumerate(lists):
        for j in list(own):
            if i not in known[j] and len(known[j]) < 2 * DEGREE:
                known[j].add(i)
    return [sorted(x) for x in known]


def range_search(vectors: np.ndarray, lists: list[np.ndarray], start: int, query: int, beam: int, near: float) -> np.ndarray:
    """Members in range of ``query``, found by a beam search and expansion within the range."""
    target = vectors[query]
    seen = np.zeros(len(vectors), bool)
    seen[start] = True
    pool, close = np.array([start]), vectors[[start]] @ target
    open_ = np.ones(1, bool)
    found = [pool[close >= near]]
    while open_.any():
        at = int(np.argmax(np.where(open_, close, -3)))
        open_[at] = False
        more = lists[pool[at]]
        more = more[~seen[more]]
        if not len(more):
            continue
        seen[more] = True
        likeness = vectors[more] @ target
        found.append(more[likeness >= near])
        pool, close = np.append(pool, more), np.append(close, likeness)
        open_ = np.append(open_, np.ones(len(more), bool))
        if len(pool) > beam:
            best = np.argpartition(-close, beam)[:beam]
            pool, close, open_ = pool[best], close[best], open_[best]
    inside = np.concatenate(found)
    ring = inside
    while len(ring):
        more = np.unique(np.concatenate([lists[i] for i in ring.tolist()]))
        more = more[~seen[more]]
        seen[more] = True
        ring = more[vectors[more] @ target >= near]
        inside = np.append(inside, ring)
    # Members of the beam search's pool that were seen but not in range need no second look.
    return np.unique(inside[inside != query])


def search_shard(ids: np.ndarray, vectors: np.ndarray, lists: list[np.ndarray], beam: int, near: float):
    """Links of all members as two columns of member numbers, in both directions."""
    medoid = int(np.argmax(vectors @ vectors.mean(0)))
    one, two = [], []
    for i in range(len(ids)):
        inside = range_search(vectors, lists, medoid, i, beam, near)
        one += [i] * len(inside)
        two += inside.tolist()
    pairs = np.array([one + two, two + one], np.int64).reshape(2, -1)
    return np.unique(pairs, axis=1)


# -- shards -----------------------------------------------------------------------------------------


def _usable() -> object:
    vector = F.col("embedding")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & ~bad & some


def _centres(nodes: DataFrame, sizes: dict[str, int]) -> dict[str, np.ndarray]:
    """k-means centres of every label, one for ``SHARD`` vectors."""
    total, found = sum(sizes.values()), {}
    enough = max(SAMPLE, 4 * min(CENTRES, -(-total // SHARD)))
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(enough)
    sample = sample.select("place", F.col("vector").cast("array<float>").alias("vector")).toPandas()
    share = min(1.0, SHARD * CENTRES / max(1, total))
    for place, rows in sample.groupby("place"):
        many = max(1, min(round(sizes[place] * share / SHARD), len(rows) // 4))
        points = unit(np.array(rows["vector"].tolist(), np.float64))
        centres = points[np.random.default_rng(3).permutation(len(points))[:many]]
        for _ in range(6 if many > 1 else 0):
            cuts = range(0, len(points), 512)
            nearest = np.concatenate([(points[low : low + 512] @ centres.T).argmax(1) for low in cuts])
            sums = np.zeros_like(centres)
            np.add.at(sums, nearest, points)
            norms = np.sqrt((sums * sums).sum(1, keepdims=True))
            centres = np.where(norms > 0, sums / np.maximum(norms, 1e-300), centres)
        found[place] = centres
    return found


def _sharded(nodes: DataFrame, centres: dict[str, np.ndarray], overlap: int) -> DataFrame:
    """``shard, node, vector, weight, shards`` for each shard of each node."""
    shared = nodes.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        for batch in batches:
            for place, rows in batch.groupby("place"):
                points = unit(np.array(rows["vector"].tolist(), np.float64))
                known = shared.value.get(place)
                if known is None:  # a label so small that the sample has none of it
                    nearest = np.zeros((len(rows), 1), np.int64)
                else:
                    many = min(overlap, len(known))
                    nearest = np.argpartition(-(points @ known.T), many - 1, 1)[:, :many]
                names = [[f"{place}/{int(i)}" for i in sorted(own)] for own in nearest]
                yield rows.assign(shards=names, vector=list(points)).drop(columns="place")

    placed = nodes.select("place", "node", "vector", "weight").mapInPandas(
        run, "node long, vector array<double>, weight long, shards array<string>"
    )
    return placed.withColumn("shard", F.explode("shards"))


def _graph(shards: DataFrame) -> DataFrame:
    """The united adjacency list of every node."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids = group["node"].to_numpy()
        lists = build_graph(np.array(group["vector"].tolist()))
        return pd.DataFrame({"node": ids, "near": [ids[own].tolist() for own in lists]})

    built = shards.groupBy("shard").applyInPandas(run, "node long, near array<long>")
    return built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _searched(shards: DataFrame, graph: DataFrame, beam: int, near: float) -> DataFrame:
    """Links counted per node, and a star per component of each shard: ``node, links, other``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        ids, weights = group["node"].to_numpy(), group["weight"].to_numpy()
        vectors = np.array(group["vector"].tolist())
        lists = []
        for own in group["near"]:
            own = np.asarray(own, np.int64)
            at = np.minimum(np.searchsorted(ids, own), len(ids) - 1)
            lists.append(at[ids[at] == own])
        one, two = search_shard(ids, vectors, lists, beam, near)
        # A pair that shares several shards counts in the first of them.
        shard, places = group["shard"].iloc[0], [sorted(s) for s in group["shards"]]
        first = [min(set(places[i]) & set(places[j])) == shard for i, j in zip(one.tolist(), two.tolist())]
        counts = np.bincount(one[first], weights[two[first]], len(ids)).astype(np.int64)
        stars = spanning(zip(ids[one].tolist(), ids[two].tolist()))
        linked = np.flatnonzero(counts)
        return pd.DataFrame(
            {
                "node": np.append(ids[linked], [s[0] for s in stars]).astype(np.int64),
                "links": np.append(counts[linked], np.zeros(len(stars))).astype(np.int64),
                "other": pd.array([None] * len(linked) + [s[1] for s in stars], dtype="Int64"),
            }
        )

    return (
        shards.join(graph, "node")
        .groupBy("shard")
        .applyInPandas(run, "node long, links long, other long")
    )


# -- the operator -------------------------------------------------------------------------------------


def _recalls(nodes: DataFrame, links: DataFrame, near: float) -> dict[str, float]:
    """For each label the mean share of their true links that were found of some nodes that have links.

    The nodes are compared with all rows.  Where few have links, more are asked.
    """
    last = Window.partitionBy("place").orderBy(F.xxhash64("node", F.lit(11)), "node")
    ranked = nodes.select("place", "node", F.row_number().over(last).alias("turn"))
    spark, known, places, low, high = nodes.sparkSession, [], None, 0, AUDITED
    while low < MOST_AUDITED and (places is None or places):
        asked = ranked.where((F.col("turn") > low) & (F.col("turn") <= high))
        asked = asked if places is None else asked.where(F.col("place").isin(places))
        queries = asked.drop("place", "turn").join(nodes, "node").join(links, "node", "left")
        queries = queries.select("node", "place", "vector", "links").toPandas()
        if not len(queries):
            break
        shared = spark.sparkContext.broadcast(
            {p: (g["node"].to_numpy(), unit(np.array(g["vector"].tolist(), np.float64))) for p, g in queries.groupby("place")}
        )

        def run(batches):
            for batch in batches:
                for place, rows in batch.groupby("place"):
                    if (own := shared.value.get(place)) is not None:
                        points = unit(np.array(rows["vector"].tolist(), np.float64))
                        others, weights = rows["node"].to_numpy(), rows["weight"].to_numpy()
                        for at in range(0, len(own[0]), 256):
                            asking = own[0][at : at + 256]
                            close = own[1][at : at + 256] @ points.T >= near
                            close &= asking[:, None] != others[None]
                            yield pd.DataFrame({"node": asking, "true": close @ weights})

        rows = nodes if places is None else nodes.where(F.col("place").isin(places))
        true = rows.select("place", "node", "vector", "weight").mapInPandas(run, "node long, true long")
        true = true.groupBy("node").agg(F.sum("true").alias("true")).toPandas()
        known.append(queries.drop(columns="vector").merge(true, on="node", how="left").fillna({"links": 0, "true": 0}))
        every = pd.concat(known)
        some = every[every["true"] > 0]
        linked, seen = some.groupby("place").size(), queries["place"].unique()
        places = [p for p in seen if linked.get(p, 0) < LINKED and (queries["place"] == p).sum() == high - low]
        low, high = high, min(4 * high, MOST_AUDITED)
    if not known:
        return {}
    return (some["links"] / some["true"]).groupby(some["place"]).mean().to_dict()


def _exact(nodes: DataFrame, sizes: dict[str, int], near: float) -> DataFrame:
    """What ``_searched`` gives, from all pairs of the nodes, in a task for each pair of blocks."""
    blocks = F.create_map(*[F.lit(x) for p, n in sizes.items() for x in (p, -(-n // EXACT))])[F.col("place")]
    own = nodes.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)).alias("with")
    dealt = own.select("place", "node", "vector", "weight", "own", other)
    dealt = dealt.withColumns({"one": F.least("own", "with"), "two": F.greatest("own", "with")})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node", ignore_index=True)
        ids, weights, of = (group[c].to_numpy() for c in ("node", "weight", "own"))
        vectors = unit(np.array(group["vector"].tolist(), np.float64))
        apart = group["one"].iloc[0] != group["two"].iloc[0]
        counts, stars = np.zeros(len(ids), np.int64), []
        for low in range(0, len(ids), 256):
            close = vectors[low : low + 256] @ vectors.T >= near
            close[np.arange(len(close)), np.arange(low, low + len(close))] = False
            if apart:
                close &= of[low : low + 256][:, None] != of[None]
            counts[low : low + 256] = close @ weights
            a, b = np.nonzero(close)
            stars = spanning([*stars, *zip(ids[a + low].tolist(), ids[b].tolist())])
        linked = np.flatnonzero(counts)
        return pd.DataFrame(
            {
                "node": np.append(ids[linked], [s[0] for s in stars]).astype(np.int64),
                "links": np.append(counts[linked], np.zeros(len(stars))).astype(np.int64),
                "other": pd.array([None] * len(linked) + [s[1] for s in stars], dtype="Int64"),
            }
        )

    return dealt.groupBy("place", "one", "two").applyInPandas(run, "node long, links long, other long")


def near_vectors(embeddings: DataFrame, near: float = NEAR) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = embeddings.sparkSession
    folder = work_folder(spark, "near_vectors")
    rows = embeddings.select("vec_id", "label", "embedding").withColumn("usable", F.coalesce(_usable(), F.lit(False)))
    place = F.concat_ws(":", F.col("label").cast("string"), F.size("embedding").cast("string"))
    usable = rows.where("usable").select(F.col("vec_id").cast("long").alias("vec_id"), place.alias("place"), "embedding")
    # Equal vectors are one node, named by the smallest id.
    nodes = usable.groupBy("place", "embedding").agg(F.min("vec_id").alias("node"), F.count_distinct("vec_id").alias("weight"))
    nodes = nodes.withColumn("vector", F.transform("embedding", lambda x: x.cast("double")))
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")
    sizes = {r.place: r.n for r in nodes.groupBy("place").agg(F.count("*").alias("n")).collect()}
    centres = _centres(nodes, sizes)
    overlap, beam = OVERLAP, BEAM
    for attempt in range(ATTEMPTS):
        _sharded(nodes, centres, overlap).write.parquet(f"{folder}/shards{attempt}")
        shards = spark.read.parquet(f"{folder}/shards{attempt}")
        _searched(shards, _graph(shards), beam, near).write.parquet(f"{folder}/links{attempt}")
        found = spark.read.parquet(f"{folder}/links{attempt}")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        short = [place for place, recall in _recalls(nodes, links, near).items() if recall < RECALL]
        if not short:
            break
        overlap, beam = overlap + 1, 2 * beam
    if short:
        missed = nodes.where(F.col("place").isin(short))
        _exact(missed, {p: sizes[p] for p in short}, near).write.parquet(f"{folder}/exact")
        found = found.join(missed.select("node"), "node", "left_anti")
        found = found.unionByName(spark.read.parquet(f"{folder}/exact"))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
    stars = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    copies = usable.join(nodes.select("place", "embedding", "node", "weight"), ["place", "embedding"])
    own = copies.join(links, "node", "left").groupBy("vec_id").agg(
        F.sum(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    same = copies.where("vec_id != node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    group = components(stars.unionByName(same)).withColumnRenamed("node", "vec_id")
    every = rows.select(F.col("vec_id").cast("long").alias("vec_id"))
    return (
        every.join(own, "vec_id", "left")
        .join(group, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
