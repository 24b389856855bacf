"""The language stage with its own limit: text of unlearned languages and short junk go, the rest stays."""

import random

import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import language

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").where("quality = 0").select("doc_id")
    return spark.read.parquet(f"{SMALL}/documents.parquet").join(labels, "doc_id", "left_anti").cache()


def share_kept(docs, model):
    return language.accepted(docs, model).count() / docs.count()


def test_held_out_text_of_learned_languages_stays(documents):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.learn(documents.where(~held_out))
    assert share_kept(documents.where(held_out), model) > 0.99


@pytest.mark.parametrize("lang", ["de", "en", "es", "fr"])
def test_a_language_never_learned_goes(documents, lang):
    model = language.learn(documents.where(F.col("lang") != lang))
    other = documents.where(F.col("lang") == lang).withColumn("text", F.substring("text", 1, 150))
    assert share_kept(other, model) < 0.12


def test_junk_goes_however_short(spark, documents):
    pick = random.Random(1)
    rows = [
        (i, "".join(pick.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(pick.randint(20, 199))))
        for i in range(200)
    ]
    rows += [(1000 + i, "жщъ " * n) for i, n in enumerate((3, 10, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert share_kept(docs, language.learn(documents)) < 0.02


def test_limits_fall_with_the_length(documents):
    found = language.limits(language.learn(documents))
    assert found[2] > found[3] > found[4] > found[6] and 4 < found[-1] < 5


def test_text_in_two_learned_languages_stays(spark, documents):
    long = [documents.where(F.col("lang") == x).where("n_chars > 1200").orderBy("doc_id").first().text for x in ("en", "fr")]
    docs = spark.createDataFrame([(1, f"{long[0][:1200]} {long[1][:1200]}")], "doc_id long, text string")
    assert share_kept(docs, language.learn(documents)) == 1
