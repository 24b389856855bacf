"""Parsing against a brute-force parser, held-out accuracy, and odd rows."""

import random
import zlib

import pyarrow as pa

from fieldpulse.llm import language
from fieldpulse.llm.blocks import blocks
from fieldpulse.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def phrases(text, reference):
    """Greedy longest phrases of ``text`` found in ``reference``, by substring search."""
    count = 0
    for low in range(0, len(text), language.RUN):
        run, at = text[low : low + language.RUN], 0
        while at < len(run):
            size = 1
            while at + size < len(run) and run[at : at + size + 1] in reference:
                size += 1
            at += size
            count += 1
    return count


def test_phrases_equal_a_substring_search():
    pick = random.Random(5)
    words = ["".join(pick.choice("abcdé") for _ in range(pick.randint(1, 6))) for _ in range(60)]
    model = tuple(
        (name, " ".join(pick.choice(words) for _ in range(90)).replace(gone, "a"))
        for name, gone in (("x", "b"), ("y", "c"))
    )
    texts = [" ".join(pick.choice(words) for _ in range(n)) for n in (1, 7, 400)] + ["z", "12", ""]
    own = language.Parser(model)
    (block,) = blocks(pa.array(texts))
    bits, letters = own.estimate(block)
    for i, text in enumerate(texts[:4]):
        for j, (_, reference) in enumerate(model):
            expected = phrases(text, reference) * own.bits[j] / letters[i]
            assert abs(bits[j, i] - expected) < 1e-9
    assert letters.tolist()[4:] == [0, 0]


def test_automaton_holds_exactly_the_substrings():
    text = [0, 1, 0, 0, 1, 1, 0]
    states = language.suffix_automaton(text)
    subs = {tuple(text[a:b]) for a in range(7) for b in range(a + 1, 8)}
    found, todo = set(), [((), 0)]
    while todo:
        so_far, state = todo.pop()
        for sign, target in states[state].items():
            found.add((*so_far, sign))
            todo.append(((*so_far, sign), target))
    assert found == subs


def test_held_out_accuracy(spark):
    known = dict(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect())
    rows = QUERIES["op2_language"](spark, SMALL).collect()
    assert len(rows) == len(known)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) / len(held) > 0.98


def test_odd_rows(spark):
    documents = spark.createDataFrame(
        [(1, "aa ab aa", "a"), (2, "zz zy", "z"), (3, None, "a"), (4, "12 !", None), (5, "", "q"), (None, "zz", None)],
        "doc_id long, text string, lang string",
    )
    model = language.learn(documents)
    assert [name for name, _ in model] == ["a", "z"]
    rows = {r.doc_id: r for r in language.identify(documents, model).collect()}
    assert [rows[i].lang_pred for i in (1, 2, None)] == ["a", "z", "z"]
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5))
    assert language.identify(documents.limit(0), model).count() == 0
    assert {r.lang_pred for r in language.identify(documents, ()).collect()} == {"und"}


def test_a_language_of_long_texts_is_learned_from_all_over_one(spark):
    size = 4 * language.REFERENCE_CHARS
    text = "".join("abcd"[4 * i // size] for i in range(size))
    model = dict(language.learn(spark.createDataFrame([(1, text, "x")], "doc_id long, text string, lang string")))
    assert set(model["x"]) == set("abcd ") and len(model["x"]) <= language.REFERENCE_CHARS + language.PIECES
