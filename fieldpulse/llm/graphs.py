"""Connected components of links, by stars that shrink round by round."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldpulse.session import work_folder


#: Edges that a node may have and still be shuffled with the others.
LEAST_SHARE = 256


class Forest:
    """Union-find over whatever can be hashed and compared; the smallest member names a tree."""

    def __init__(self):
        self._up: dict = {}

    def root(self, node):
        up = self._up
        top = node
        while (above := up.get(top, top)) != top:
            top = above
        while node != top:
            up[node], node = top, up.get(node, node)
        return top

    def join(self, one, two) -> bool:
        """Whether the two were apart."""
        one, two = self.root(one), self.root(two)
        if one == two:
            return False
        self._up[max(one, two)] = min(one, two)
        self._up.setdefault(min(one, two), min(one, two))
        return True

    def stars(self) -> list[tuple]:
        return [(node, top) for node in self._up if (top := self.root(node)) != node]


def spanning(links: Iterable[tuple]) -> list[tuple]:
    """A star per component of links seen by one task."""
    forest = Forest()
    for one, two in links:
        forest.join(one, two)
    return forest.stars()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``links(a, b)``: the smallest node it can reach.

    Alternates two steps until nothing changes: every node hands its larger neighbours to its
    smallest one, then its smaller neighbours.  Each needs the minimum per node, which partitions
    compute before the shuffle, and a join.  Nodes with more than a share of all edges, of which there
    are few by that, are joined by broadcast and only the others' edges are shuffled; so a component of
    any size is never gathered.  Rounds are written to the shared folder, which cuts the lineage.
    """
    spark = links.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder, number = work_folder(spark, "components"), 0

    def kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal number
        number += 1
        path = f"{folder}/{number}"
        edges.distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        ends = edges.select(F.explode(F.array("a", "b")).alias("node"), F.xxhash64("a", "b").cast("decimal(38,0)").alias("name"))
        nodes = ends.groupBy("node").agg(F.count(F.lit(1)).alias("edges"), F.sum("name").alias("names"))
        return edges, tuple(nodes.agg(F.sum("edges"), F.sum("names"), F.max("edges")).first())

    def with_least(edges: DataFrame, many: int, most: int) -> DataFrame:
        """Edges with the least neighbour of ``a``; ``many`` is at least about their number, and no
        node has more than ``most``."""
        share = max(LEAST_SHARE, many // (8 * tasks))
        if most <= share:
            return edges.join(edges.groupBy("a").agg(F.min("b").alias("least")), "a")
        found = edges.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("edges"))
        often = F.broadcast(found.where(F.col("edges") > share).select("a", "least"))
        seldom = edges.join(often.select("a"), "a", "left_anti").join(found.select("a", "least"), "a")
        return seldom.unionByName(edges.join(often, "a"))

    larger_first = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    edges, state = kept(links.where("a != b").select(*larger_first))
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = F.least("a", "least").alias("b")
        large = with_least(both, state[0], state[2]).where("b > a").select(F.col("b").alias("a"), smallest)
        large = large.where("a != b").distinct()
        small = with_least(large, state[0], state[2]).select(
            F.explode(
                F.array(
                    F.struct("a", F.col("least").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                )
            ).alias("e")
        )
        edges, after = kept(small.select("e.*").where("a != b"))
        if after == state:
            break
        state = after
    stars = edges.groupBy("a").agg(F.min("b").alias("b"))
    centres = stars.select("b").distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        centres.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )
