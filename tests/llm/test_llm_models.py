"""Language and quality models: held-out accuracy and edge cases."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatprep.llm import language_id, quality_classifier
from chatprep.llm.common import read_table
from chatprep.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@needs_tables
def test_languages_of_held_out_documents(spark):
    found = QUERIES["op5_language_id"](spark, FOLDER).filter("held_out")
    joined = found.join(read_table(spark, FOLDER, "documents"), "doc_id")
    right, total, low, high = joined.agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")
    ).first()
    assert total > 200 and right / total > 0.98
    assert 0 <= low and high <= 1


@needs_tables
def test_quality_of_held_out_documents(spark):
    found = QUERIES["op3_quality_classifier"](spark, FOLDER).filter("held_out")
    joined = found.join(read_table(spark, FOLDER, "labels"), "doc_id")
    right, total = joined.agg(F.sum((F.col("quality") == F.col("predicted")).cast("int")), F.count("*")).first()
    assert total > 50 and right / total > 0.95


def test_spectrum_counts_presence_of_all_lengths():
    assert len(language_id.spectrum("a")) == 1
    assert len(language_id.spectrum("ab")) == 3
    assert len(language_id.spectrum("abcabc")) == 3 + 3 + 3
    assert (language_id.spectrum("ABC") == language_id.spectrum("abc")).all()


def test_texts_without_letters_are_unknown(spark):
    rows = [(i, t, "en") for i, t in enumerate(["the cat and the dog", "that was the one", None, "", "123 !!", "١٢"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.train(docs, F.col("lang"))
    got = [tuple(r["p"]) for r in docs.orderBy("doc_id").select(language_id.predictor(model)("text").alias("p")).collect()]
    assert [g[0] for g in got] == ["en", "en", "und", "und", "und", "und"]
    assert all(g[1] == 0 for g in got[2:])
    none = docs.select(language_id.predictor(None)("text").alias("p")).collect()
    assert {r["p"]["lang_pred"] for r in none} == {"und"}


def test_stage_goes_by_the_score(spark):
    draw = random.Random(5)
    words = {"en": "the cat and dog that was one house tree with water".split(), "de": "der hund und katze das war ein haus baum mit wasser".split()}
    rows = [(i, " ".join(draw.choices(words[lang], k=30)), lang) for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(900, "съешь же ещё этих мягких французских булок да выпей чаю " * 2, None), (901, "the", None), (902, "42 !", None), (903, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r["doc_id"] for r in language_id.language_stage(spark, docs, "").collect()}
    assert kept == {*range(120), 901}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = {r["doc_id"] for r in language_id.language_stage(spark, unlabelled, "").collect()}
    assert kept == {*range(120), 900, 901}


def test_compiled_rules_score_like_the_fitted_ones(spark):
    draw = np.random.default_rng(0)
    x = draw.random((600, len(quality_classifier.STATISTICS)))
    y = ((x[:, 2] < 0.7) & (x[:, 6] > 0.2)).astype(float)
    model = quality_classifier.fit(x, y)
    table = spark.createDataFrame([tuple(map(float, r)) for r in x], [*quality_classifier.STATISTICS])
    got = np.array([r[0] for r in table.select(model.score()).collect()])
    total = np.full(len(x), model.intercept)
    for rule, weight in model.rules:
        total += weight * quality_classifier._holds(rule, x)
    want = 1 / (1 + np.exp(-total))
    assert np.allclose(np.sort(got), np.sort(want))
    assert ((want > 0.5) == (y > 0.5)).mean() > 0.97
    assert len(model.rules) < 60


def test_one_class_and_no_labels():
    assert quality_classifier.fit(np.zeros((0, 3)), np.zeros(0)).rules == []
    assert quality_classifier.fit(np.zeros((5, 10)), np.ones(5)).intercept > 0
