"""Tasks of the pipeline take bounded shares, read packed rows one by one and give memory back."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import blocks, graphs, near_sets, repeats
from fieldpulse.llm.exchange import targets_for


class Stop(Exception):
    pass


@pytest.mark.parametrize("module, run", [(repeats, "repeated_spans"), (near_sets, "near_components")])
def test_a_task_that_sorts_takes_eight_million_characters(spark, monkeypatch, module, run):
    frame = spark.range(18).select(F.col("id").alias("doc_id"), F.repeat(F.lit("a "), 500_000).alias("text"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []

    def counted(*args, **options):
        found.append(targets_for(*args, **options))
        raise Stop

    monkeypatch.setattr(module, "targets_for", counted)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        with pytest.raises(Stop):
            getattr(module, run)(frame)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == [3]  # 18 million characters


def test_memory_goes_back_when_a_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(blocks, "_give_back", lambda: given.append(True))
    task = blocks.tidied(lambda batches: (2 * x for x in batches))
    found = task(iter([1, 2]))
    assert next(found) == 2 and not given
    assert list(found) == [4] and given


def test_packed_values():
    column = pa.array([b"ab", None, b"", b"cde"], pa.binary())
    assert [bytes(v) for v in blocks.values_of(column)] == [b"ab", b"", b"cde"]


def test_packed_keys_may_be_views():
    entries, hashes = np.zeros(2, repeats._ENTRY), np.arange(3, dtype=np.uint64)
    entries["key"], entries["many"] = [5, 6], [1, 2]
    raw = b"K" + repeats._packed(entries, hashes)
    found, found_hashes = repeats._unpacked(memoryview(raw)[1:])
    assert np.array_equal(found, entries) and np.array_equal(found_hashes, hashes)


@pytest.mark.parametrize("share", [2, 256])
def test_components_with_and_without_nodes_of_many_edges(spark, monkeypatch, share):
    monkeypatch.setattr(graphs, "LEAST_SHARE", share)
    pick = np.random.default_rng(share)
    links = [(int(a), int(b)) for a, b in pick.integers(0, 60, (45, 2))] + [(100, i) for i in range(101, 120)]
    forest = graphs.Forest()
    for a, b in links:
        forest.join(a, b)
    found = {r.node: r.component for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {n: forest.root(n) for a, b in links if a != b for n in (a, b)}
