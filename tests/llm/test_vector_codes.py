"""Vector codes against a plain search over all entries, and the whole operator against plain loops."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from fieldpulse.llm import vector_codes as vc


def plain_nearest(parts, entries):
    distances = ((parts[:, None] - entries[None]) ** 2).sum(2)
    return distances.argmin(1), distances.min(1)


@pytest.mark.parametrize("spread", [2, 40, 1 << 20])
@pytest.mark.parametrize("leaves", [1, 7, 256])
def test_the_trie_finds_the_nearest_entry(monkeypatch, spread, leaves):
    monkeypatch.setattr(vc, "LEAVES", leaves)
    pick = np.random.default_rng(spread)
    for width, count in ((1, 300), (3, 900), (8, 500)):
        rows = pick.integers(-spread, spread, (count, width))
        rows[: count // 2, : width - 1] = rows[0, : width - 1]  # one deep common prefix
        parts, which, often = vc.distinct_parts(rows)
        assert (parts[which] == rows).all() and often.sum() == count
        assert [tuple(r) for r in parts.tolist()] == sorted({tuple(r) for r in rows.tolist()})
        entries = pick.integers(-spread, spread, (20, width))
        entries[7] = entries[3]  # a tie for every part
        for found, wanted in zip(vc.nearest(parts, entries), plain_nearest(parts, entries)):
            assert (found == wanted).all()


def test_no_parts():
    index, distance = vc.nearest(np.zeros((0, 3), np.int64), np.zeros((1, 3), np.int64))
    assert len(index) == len(distance) == 0


def plain(rows, parts=4, entries=256, rounds=4):
    """The contract by loops, over (id, vector, label) rows."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = {i: [math.floor(1024 * x) for x in v] for i, v, _ in kept}
    width = len(next(iter(whole.values()))) // parts
    cut = {i: [v[p * width : (p + 1) * width] for p in range(parts)] for i, v in whole.items()}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for own in cut.values():
                groups.setdefault(best(own[p], books[p])[1], []).append(own[p])
            books[p] = [
                [sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e
                for k, e in enumerate(books[p])
            ]
    found = {i: [best(own[p], books[p]) for p in range(parts)] for i, own in cut.items()}
    errors = {i: sum(d for d, _ in f) for i, f in found.items()}
    labels = {i: label for i, _, label in kept}
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(
        (i, "".join(f"{k:02x}" for _, k in f), errors[i], sum(e for j, e in errors.items() if labels[j] == labels[i]), digest)
        for i, f in found.items()
    )


def made_rows(count=400, width=8, seed=4):
    pick = np.random.default_rng(seed)
    vectors = pick.normal(0, 0.2, (count, width)).round(2)
    vectors[::3] = vectors[0]  # a third of the rows are copies of one vector
    return [(i * 3 + 1, v.tolist(), None if i % 5 == 0 else i % 3) for i, v in enumerate(vectors)]


SCHEMA = "vec_id long, embedding array<double>, label int"


def result(spark, rows, schema=SCHEMA):
    return sorted(tuple(r) for r in vc.compress(spark.createDataFrame(rows, schema)).collect())


def test_whole_operator_equals_plain_loops(spark):
    rows = made_rows()
    rows += [(0, None, 1), (2, [0.1] * 7 + [None], 1), (5, [math.nan] * 8, 1), (8, [math.inf] + [0.0] * 7, 1)]
    assert result(spark, rows) == plain(rows)


def test_fewer_vectors_than_entries(spark):
    rows = made_rows(9)
    found = result(spark, rows)
    assert found == plain(rows) and {r[2] for r in found} == {0}


def test_many_labels(spark, monkeypatch):
    monkeypatch.setattr(vc, "FEW_TOTALS", 2)
    rows = made_rows(300)
    rows = [(i, v, 7 if i % 2 else label if label is None else i) for i, v, label in rows]
    assert result(spark, rows) == plain(rows)


def test_edge_rows(spark):
    assert result(spark, [], SCHEMA) == []
    rows = [(1, [0.5] * 8, 1), (1, [0.5] * 8, 1), (None, [0.25] * 8, None), (2, [], 1), (3, [0.5] * 4, 1)]
    found = vc.compress(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.vec_id or 0, r.error, r.label_error) for r in found.collect()) == [(0, 0, 0), (1, 0, 0), (1, 0, 0)]
    schema = "vec_id string, embedding array<float>, label string, code int, error int, n int, p int, part int, _by int"
    odd = [(f"v{i}", [0.5, i / 7, 0.0, 0.25, 1.0], "x", 1, 2, 3, 4, 5, 6) for i in range(3)]
    found = vc.compress(spark.createDataFrame(odd, schema)).orderBy("vec_id").collect()  # five components, padded to eight
    assert [(r.vec_id, r.code, r.error) for r in found] == [("v0", "00000000", 0), ("v1", "01000000", 0), ("v2", "02000000", 0)]
    with pytest.raises(Exception, match="must stay below"):
        vc.compress(spark.createDataFrame([(1, [1e9] * 4, 1)], SCHEMA)).collect()


def test_codes_decode_to_near_vectors(spark):
    frame = spark.createDataFrame(made_rows(), SCHEMA)
    books = vc.train(frame)
    codes = vc.encode(frame, books)
    errors = {r.vec_id: r.error for r in codes.collect()}
    back = {r.vec_id: r.vector for r in vc.decode(codes, books).collect()}
    for i, vector, _ in made_rows():
        whole = np.floor(1024 * np.array(vector))
        assert ((whole - np.array(back[i]) * 1024) ** 2).sum() == errors[i]


def test_integers_are_floors():
    column = pa.array([[-0.0001, 0.5], [1 / 1024, -1 / 1024]], pa.list_(pa.float32()))
    assert vc.integers(column, 2, 2, 1024).tolist() == [[-1, 512], [1, -1]]
