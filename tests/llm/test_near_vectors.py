"""Recall and precision against all pairs, pruning, and odd rows."""

import numpy as np
import pytest

from fieldpulse.llm import near_vectors as nv
from fieldpulse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def all_links(rows, near=nv.NEAR):
    links = set()
    by = {}
    for vec, vector, label in rows:
        by.setdefault(label, []).append((vec, np.array(vector, np.float64)))
    for label, own in by.items():
        ids = [i for i, _ in own]
        points = nv.unit(np.array([v for _, v in own]))
        for a, b in zip(*np.nonzero(points @ points.T >= near)):
            if a != b:
                links.add((ids[a], ids[b]))
    return links


def roots(ids, links):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return {i: root(i) for i in ids}


def clustered(seed, many, dimensions=16):
    """Tight and loose clusters with copies, in a few labels."""
    pick = np.random.default_rng(seed)
    rows = []
    while len(rows) < many:
        centre = pick.normal(size=dimensions)
        label = int(pick.integers(0, 3))
        for _ in range(int(pick.integers(1, 12))):
            vector = centre + pick.normal(size=dimensions) * pick.choice([0, 0.02, 0.1, 0.2])
            rows.append((len(rows), vector.astype(np.float32).tolist(), label))
    return rows


@pytest.mark.parametrize("shard", [60, 5000])
def test_links_of_clustered_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(nv, "SHARD", shard)
    rows = clustered(1, 1500)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    found = {r.vec_id: r for r in nv.near_vectors(frame).collect()}
    links = all_links(rows)
    assert len(found) == len(rows) and len(links) > 1000
    counts = {i: sum(1 for a, _ in links if a == i) for i in found}
    assert all(found[i].n_links <= counts[i] for i in found)
    assert sum(r.n_links for r in found.values()) >= 0.95 * len(links)
    truth = roots(list(found), links)
    assert np.mean([found[i].component_id == truth[i] for i in found]) > 0.95
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_pruning_keeps_one_of_a_tight_group():
    points = nv.unit(np.array([[1, 0.01], [1, 0.011], [1, 0.012], [0, 1.0]]))
    own = nv.unit(np.array([[1.0, 0.3]]))[0]
    kept = nv.robust_prune(1 - points @ own, 1 - points @ points.T, 4)
    assert kept == [2, 3]


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    links = all_links([tuple(r) for r in rows])
    found = {r.vec_id: r for r in QUERIES["op9_near_vectors"](spark, SMALL).collect()}
    assert len(found) == len(rows)
    assert 0.95 * len(links) <= sum(r.n_links for r in found.values()) <= len(links)


def test_odd_rows(spark):
    v, nan, inf = [1.0, 2.0], [float("nan"), 1.0], [float("inf"), 1.0]
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [], 0), (8, [0.0, 0.0], 0), (9, nan, 0), (10, inf, 0), (11, [1.0, None], 0), (12, [1.0, 2.0, 0.0], 0), (None, v, 0), (13, [-1.0, -2.0], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in nv.near_vectors(frame).collect()}
    assert found[1] == (2, 1, True) and found[2] == found[3] == (2, 1, False)
    assert found[None] == (0, None, None)
    assert all(found[i] == (0, i, True) for i in range(4, 14))
    assert nv.near_vectors(frame.limit(0)).count() == 0
