"""Labels in which the graphs miss links are compared exactly, however dense another label is."""

import numpy as np
import pytest

from fieldpulse.llm import near_vectors as nv


def brute_force(rows):
    found = {}
    for label in {r[1] for r in rows}:
        ids = np.array([r[0] for r in rows if r[1] == label])
        points = nv.unit(np.array([r[2] for r in rows if r[1] == label]))
        close = points @ points.T >= nv.NEAR
        np.fill_diagonal(close, False)
        up = list(range(len(ids)))
        for _ in range(len(ids)):
            new = [min([up[i], *(up[j] for j in np.flatnonzero(close[i]))]) for i in range(len(ids))]
            if new == up:
                break
            up = new
        found |= {int(d): (int(c.sum()), int(ids[up[i]])) for i, (d, c) in enumerate(zip(ids, close))}
    return found


@pytest.mark.parametrize("exact", [40, 2_000])
def test_rare_links_beside_a_dense_label(spark, monkeypatch, exact):
    monkeypatch.setattr(nv, "SHARD", 3)
    monkeypatch.setattr(nv, "OVERLAP", 1)
    monkeypatch.setattr(nv, "ATTEMPTS", 1)
    monkeypatch.setattr(nv, "EXACT", exact, raising=False)
    pick = np.random.default_rng(4)
    centre = pick.normal(size=8)
    rows = [(i, "dense", (centre + 0.01 * pick.normal(size=8)).tolist()) for i in range(80)]
    for i in range(300):
        point = nv.unit(pick.normal(size=(1, 8)))[0]
        rows += [(1000 + 2 * i + j, "rare", (point + 0.06 * pick.normal(size=8)).tolist()) for j in range(2)]
    frame = spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")
    expected = brute_force(rows)
    assert sum(n > 0 for n, _ in list(expected.values())) > 150
    # One shard a vector: pairs on either side of a border are lost without an exact way.
    found = {r.vec_id: (r.n_links, r.component_id) for r in nv.near_vectors(frame).collect()}
    rare = {i for i in expected if i >= 1000}
    assert {i: found[i] for i in rare} == {i: expected[i] for i in rare}
