"""Phrases against plain counts, and automata against dictionaries."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from fieldpulse.llm import phrases as ph
from fieldpulse.llm.blocks import blocks


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain_counts(rows):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        for words in words_of(text):
            totals[lang or "und" if lang is None else lang] += len(words)
            for size in (1, 2, 3):
                counts["und" if lang is None else lang].update(zip(*(words[i:] for i in range(size))))
    return counts, totals


def plain(rows, least=10, inside=50, top=2000):
    counts, totals = plain_counts(rows)
    found = []
    for lang, own in counts.items():
        wanted = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        lines = []
        for p, a in wanted.items():
            longer = [f for q, f in wanted.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * f >= inside * a for f in longer):
                continue
            score, _, l, r = min(
                (10**6 * a * a // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))
            )
            lines.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, text, l, r) in enumerate(sorted(lines)[:top], 1):
            found.append((lang, rank, text.decode(), -a, l, r, totals[lang], -score))
    return sorted(found)


def made_rows(count=120, seed=2):
    pick = random.Random(seed)
    words = ["the", "of", "New", "york", "city", "état", "a", "B", "日本", "x.y", "it's"]
    weights = [30, 15, 5, 5, 4, 3, 8, 3, 2, 2, 2]
    rows = []
    for i in range(count):
        parts = pick.choices(words, weights, k=pick.randint(0, 60))
        joins = pick.choices([" ", "\t ", ". ", ",", "\n", " ! "], [60, 3, 4, 3, 2, 2], k=len(parts))
        rows.append(("".join(w + j for w, j in zip(parts, joins)), pick.choice(["en", "fr", None, ""])))
    rows += [("new york city " * 30, "en"), ("Rare pair. " * 12, "en"), ("Rare pair " * 12, "de")] * 2
    return rows + [(None, "en"), ("", None), (" .,; ", "xx")]


def result(spark, rows, schema="text string, lang string", **more):
    return sorted(tuple(r) for r in ph.collocations(spark.createDataFrame(rows, schema), **more).collect())


@pytest.mark.parametrize("shard,chars", [(2_000_000, 12 << 20), (150, 700)])
def test_phrases_equal_plain_counts(spark, monkeypatch, shard, chars):
    """Also with many small shards and ranges, whose cuts divide frequent words and pairs."""
    monkeypatch.setattr(ph, "SHARD_WORDS", shard)
    monkeypatch.setattr(ph, "CHARS_PER_RANGE", chars)
    rows = made_rows()
    assert result(spark, rows) == plain(rows)
    assert result(spark, rows, least=3, inside_percent=80, top=7) == plain(rows, 3, 80, 7)


def test_frequent_prefixes_are_not_gathered(spark, monkeypatch):
    monkeypatch.setattr(ph, "LEAST_SHARE", 2)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        rows = made_rows()
        assert result(spark, rows, least=2) == plain(rows, 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_the_walk_goes_on_in_the_next_batch(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = made_rows()
        assert result(spark, rows, least=2) == plain(rows, 2)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def shard_of(rows):
    shard = ph.Shard()
    for block in blocks(pa.array([t for t, _ in rows], pa.string()), 300):
        shard.add(block, [lang for _, lang in rows[block.first : block.first + block.size]])
    return shard


def test_automata_hold_every_path():
    rows = made_rows(40)
    counts, totals = plain_counts(rows)
    numbers = {}
    shards = [shard_of(rows[:25]), shard_of(rows[25:])]
    parts = [ph.Automaton.unpacked(a.packed(s.languages), numbers) for s in shards for _, a in s.automata([])]
    made, parent2, parent3 = ph.united(parts)
    names, raw = list(numbers), made.data.tobytes()
    ends = np.cumsum(made.sizes)
    one = [(names[g], raw[e - n : e].decode()) for g, e, n in zip(made.language, ends, made.sizes)]
    spelled = dict(zip(made.symbols[0].tolist(), (w for _, w in one)))
    found = {(g, (w,)): f for (g, w), f in zip(one, made.weights[0].tolist())}
    for s, up, f in zip(made.symbols[1].tolist(), parent2.tolist(), made.weights[1].tolist()):
        found[one[up][0], (one[up][1], spelled[s])] = f
    for s, up, f in zip(made.symbols[2].tolist(), parent3.tolist(), made.weights[2].tolist()):
        first = one[parent2[up]]
        found[first[0], (first[1], spelled[int(made.symbols[1][up])], spelled[s])] = f
    assert found == {(lang, p): f for lang, own in counts.items() for p, f in own.items()}
    assert made.degrees[0].sum() == len(made.symbols[1]) and made.degrees[1].sum() == len(made.symbols[2])


def test_cuts_divide_the_paths_in_order():
    shard = shard_of(made_rows(60))
    ((paths, counts, keys),) = shard.paths()
    whole = list(zip(*(p.tolist() for p in paths)))
    assert whole == sorted(set(whole)) and counts.sum() == shard.words
    cuts = sorted({whole[5], whole[len(whole) // 2], (whole[9][0], whole[9][1] + 1, 0), (1, 0, 0)})
    assert ph._places(cuts, paths, keys) == [sum(p < c for p in whole) for c in cuts]


def test_scores_beyond_64_bits_are_exact(spark):
    a, l, r = 987_654_321_987, 998_877_665_544_332, 999_999_999_999_999
    frame = spark.createDataFrame([(a, l, r)], "a long, l1 long, r1 long")
    assert frame.select(ph._score("l1", "r1")).first()[0] == 10**6 * a * a // (l * r)


def test_edge_tables(spark):
    assert result(spark, []) == []
    assert result(spark, [(None, None), ("", "en"), ("one word", "en")]) == []
    rows = [(1, "a b " * 10, "en", 1, 2, "x", 3)] * 2
    schema = "doc_id int, text string, lang string, f int, rank int, word string, s1 int"
    assert result(spark, rows, schema) == plain([(r[1], r[2]) for r in rows])
    long = [("alpha beta gamma " * 40_000, "en"), ("x" * 100_000 + " y z. " * 20, "en")]
    assert result(spark, long) == plain(long)
