"""What is sent to verify large families in which few pairs are possible."""

from pyspark.sql import functions as F

from fieldpulse.llm import near_sets
from tests.llm.test_near_sets import brute_force


def test_sparse_family_sends_each_text_to_few_jobs(spark, monkeypatch):
    monkeypatch.setattr(near_sets, "TILE", 8)
    sent, links = [], near_sets._links

    def spied(documents, members, shingle, percent):
        sent.append((near_sets._jobs(members, percent).count(), members.select("doc").distinct().count()))
        return links(documents, members, shingle, percent)

    monkeypatch.setattr(near_sets, "_links", spied)
    # Each document links with its neighbours in a chain only.
    words = [f"w{i}" for i in range(700)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(200)]
    rows += [(1000 + i, "no link here " + " ".join(f"z{i}x{j}" for j in range(30))) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(map(tuple, near_sets.near_components(frame).collect()))
    assert found == brute_force(rows)
    (jobs, docs), = sent
    assert docs == 200
    assert jobs < 10 * docs  # all pairs of tiles: 25


def test_families_hold_all_possible_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_sets, "TILE", 4)
    chain = [(i + 1, i) for i in range(40)]
    star = [(100 + i, 100) for i in range(1, 30)]
    small = [(201, 200), (202, 200)]
    possible = spark.createDataFrame(chain + star + small, "a long, b long")
    found = near_sets._families(possible, near_sets.components(possible))
    sets = {r.cluster: set(r.docs) for r in found.groupBy("cluster").agg(F.collect_list("doc").alias("docs")).collect()}
    assert all(any({a, b} <= s for s in sets.values()) for a, b in chain + star + small)
    assert sets[100] == {100, *range(101, 130)} and sets[200] == {200, 201, 202}
    assert max(len(s) for c, s in sets.items() if c < 100) == 2
    assert {(r.cluster, r.many) for r in found.collect()} == {(c, len(s)) for c, s in sets.items()}


def test_texts_sent_are_those_of_members(spark):
    texts = spark.range(20_000).select(F.col("id").alias("doc"), F.lit("x").alias("text"))
    members = spark.range(0, 20_000, 50).select(F.col("id").alias("doc"))
    kept = {r.doc for r in near_sets._mostly(texts, members).collect()}
    assert kept >= set(range(0, 20_000, 50))
    assert len(kept) < 600
    assert near_sets._mostly(texts, members.limit(0)).count() == 0
