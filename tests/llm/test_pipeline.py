"""Every stage on what its predecessor kept, against brute force or its operator's tested rows."""

import pytest

import corpus_pipeline
from fieldpulse.llm import language, near_sets, packing, repeats
from tests.conftest import SMALLEST
from tests.llm.test_corpus_near import smallest_of_each
from tests.llm.test_packing import assert_gapless
from tests.llm.test_repeats import brute_force as repeat_brute_force
from tests.llm.test_repeats import words_of


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage, the documents first."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], SMALLEST).write.parquet(str(folder / name))
        kept.append(spark.read.parquet(str(folder / name)))
    return kept


def test_columns_stay(stages):
    for docs in stages[:-1]:
        assert docs.schema.simpleString() == stages[0].schema.simpleString()


def test_quality_and_language_keep_clean_documents(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALLEST}/labels.parquet").collect()}
    before, after, spoken = ({r.doc_id for r in s.select("doc_id").collect()} for s in stages[:3])
    good, bad = ({d for d in before if labels.get(d) == q} for q in (1, 0))
    assert good <= after and len(bad & after) <= len(bad) // 4
    assert spoken == after


def test_near_copies_leave_one_each(stages):
    before, after = ([(r.doc_id, r.text) for r in s.collect()] for s in stages[2:4])
    expected = smallest_of_each(before)
    assert {doc for doc, _ in after} == expected and len(after) == len(expected) < len(before)


def test_repeats_go(stages):
    before, after = ({r.doc_id: r for r in s.collect()} for s in stages[3:5])
    expected = repeat_brute_force([(d, r.text) for d, r in before.items()], 20)
    assert after.keys() == before.keys()
    for doc, (words, total) in expected.items():
        assert words_of(after[doc].text) == words
        assert after[doc].n_chars == len(after[doc].text)
        if len(words) == total:
            assert after[doc].text == before[doc].text


def test_run_packs_all(spark, stages):
    rows = corpus_pipeline.run(spark, SMALLEST).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in stages[4].select("doc_id").collect()}
    assert_gapless(rows, packing.CAPACITY)
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in stages[5].collect()
    )


def test_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (None, "good words here", None, None, None), (2, "", "en", "s", 0)]
    rows += [(3, "12 34", "en", "s", 5), (4, "good words here", "en", "s", 15), (5, "qq zx jk vw " * 30, "xx", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    model = language.learn(docs.where("lang = 'en'"))
    assert {r.text for r in language.accepted(docs, model, 3.0).collect()} == {"good words here"}
    assert near_sets.representatives(docs).count() == 6
    assert repeats.without_repeats(docs).count() == 6
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs.limit(0), SMALLEST).count() == 0
