"""Results that SQL cannot express, recomputed the plain way: op3, op5 and the rows of the pipeline."""

import collections
import math
import os
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from chatprep.llm import language_id, quality_classifier
from chatprep.llm.common import is_held_out, read_table
from chatprep.llm.queries import QUERIES
from test_llm_jaccard import brute

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [s for s in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    chars, n, m = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    return {
        "words": math.log1p(len(words)),
        "word_length": chars / n,
        "symbols": sum(c in "#*$%&|<>" for c in text) / chars,
        "upper": sum(unicodedata.category(c) == "Lu" for c in text) / chars,
        "marks": sum(c in "!?;:=~^@\\" for c in text) / chars,
        "digits": sum(c in "0123456789" for c in text) / chars,
        "distinct_words": len(set(words)) / n,
        "stutter": sum(a == b for a, b in zip(words, words[1:])) / n,
        "distinct_lines": len(set(lines)) / m,
        "line_words": math.log1p(n / m),
    }


ODD_TEXTS = [None, "", " \n\t ", "a a a b", "ÄÖ é\nÄÖ é\n\nx", "[^a]&&b \\ ^ ~ @", "\U0001d400 \U0001f600|#", "7 seven\n7 seven", "w " * 30_000]


def test_statistics_of_odd_texts(spark):
    table = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id bigint, text string")
    rows = quality_classifier.with_statistics(table).orderBy("doc_id").collect()
    for text, row in zip(ODD_TEXTS, rows):
        assert {k: row[k] for k in quality_classifier.STATISTICS} == pytest.approx(statistics(text), abs=1e-12), text


@needs_tables
def test_quality_query_against_the_plain_rules(spark):
    docs = read_table(spark, FOLDER, "documents")
    labels = read_table(spark, FOLDER, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    model = quality_classifier.train(docs, labels.filter(~is_held_out(F.col("doc_id"), 5, 0)))
    assert model.rules

    def score(text):
        values = statistics(text)
        x = [values[k] for k in quality_classifier.STATISTICS]
        held = [w for rule, w in model.rules if all((x[t.statistic] > t.at) == t.above for t in rule)]
        return 1 / (1 + math.exp(-model.intercept - sum(held)))

    got = {r["doc_id"]: r for r in QUERIES["op3_quality_classifier"](spark, FOLDER).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc_id, text in texts:
        want = score(text)
        assert got[doc_id]["score"] == pytest.approx(want, abs=1e-9)
        assert got[doc_id]["predicted"] == (want >= 0.3)
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


@needs_tables
def test_language_query_against_plain_kernels(spark):
    """Kernels from sets of strings, ridge regression as one least squares problem."""
    docs = read_table(spark, FOLDER, "documents")
    label = F.when(~is_held_out(F.col("doc_id"), 4, 2), F.col("lang"))
    rows = [(lang, text) for lang, text in language_id.labelled_sample(docs, label) if text]
    languages = sorted({lang for lang, _ in rows})

    def grams(text):
        text = text.lower()
        return {text[i : i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1)}

    marks = [grams(t) for lang in languages for t in [t for l, t in rows if l == lang][: language_id.LANDMARKS]]

    def kernel(sets):
        return np.array([[len(s & m) / math.sqrt(len(s) * len(m)) for m in marks] for s in sets])

    values, vectors = np.linalg.eigh(kernel(marks))
    keep = values > 1e-6 * values.max()
    features = vectors[:, keep] / np.sqrt(values[keep])
    z = kernel([grams(t) for _, t in rows]) @ features
    counts = collections.Counter(lang for lang, _ in rows)
    weight = np.sqrt([1 / counts[lang] / len(languages) for lang, _ in rows])[:, None]
    y = np.array([[1.0 if lang == c else -1.0 for c in languages] for lang, _ in rows])
    penalty = math.sqrt(language_id.RIDGE / len(rows)) * np.eye(z.shape[1], z.shape[1] + 1)
    left = np.vstack([weight * np.column_stack([z, np.ones(len(z))]), penalty])
    right = np.vstack([weight * y, np.zeros((z.shape[1], len(languages)))])
    solved = np.linalg.lstsq(left, right, rcond=None)[0]

    got = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, FOLDER).collect()}
    texts = docs.select("doc_id", "text").collect()
    assert len(got) == len(texts)
    for doc_id, text in texts:
        row = got[doc_id]
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        if not text or not any(map(str.isalpha, text)):
            assert (row["lang_pred"], row["score"]) == ("und", 0)
            continue
        scores = (kernel([grams(text)]) @ features @ solved[:-1] + solved[-1])[0]
        assert row["score"] == pytest.approx(min(max((scores.max() + 1) / 2, 0), 1), abs=1e-6)
        assert row["lang_pred"] == languages[scores.argmax()]


WORDS = {
    "en": "the cat and dog that was one house tree with water".split(),
    "de": "der hund und katze das war ein haus baum mit wasser".split(),
}


def small_corpus():
    """Rows of documents, and the ids that language ID ought to reject."""
    draw = random.Random(8)
    lang = ["en", "de"]
    rows = [(i, " ".join(draw.choices(WORDS[lang[i % 2]], k=30)), lang[i % 2], "a" if i % 3 == 0 else "b") for i in range(120)]
    passage = " ".join(draw.choices(WORDS["en"], k=14))
    words = [t.split() for _, t, *_ in rows]
    rows += [
        (200, rows[0][1], "en", "b"),  # an exact copy
        (201, rows[1][1] + " baum", "de", "a"),  # a near copy, and a copy of that one
        (202, "haus " + rows[1][1] + " baum", "de", "b"),
        (203, " ".join(words[2][:15] + words[4][:15]), "en", "b"),  # half of each: a clean document
        (300, rows[6][1] + " " + passage, "en", "a"),
        (301, passage.upper() + " " + rows[8][1], "en", "b"),
        (302, " ".join(passage.split()[:9]) + " " + rows[10][1], "en", "a"),  # nine words are no window
    ]
    rejected = [(400, "съешь же ещё этих мягких французских булок да выпей чаю " * 3, None, "a"), (401, "42 ! 17", "en", "a"), (402, None, "en", "b"), (403, "", "de", "b")]
    return rows + rejected, {r[0] for r in rejected}, passage


def test_pipeline_rows_against_brute_force(spark, tmp_path):
    rows, rejected, passage = small_corpus()
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], schema)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    texts = {i: (t, s) for i, t, _, s in rows if i not in rejected}
    classes = brute([(i, t) for i, (t, _) in texts.items()], 5, 8, 10)
    texts = {i: t for i, t in texts.items() if classes[i][1] == i}
    windows = {tuple(passage.split()[k : k + 10]) for k in range(5)}

    def is_clean(text):
        words = text.lower().split()
        return not any(tuple(words[k : k + 10]) in windows for k in range(len(words) - 9))

    clean = {i: t for i, t in texts.items() if is_clean(t[0])}
    assert {0, 1, 203, 302} <= set(clean) and not {200, 201, 202, 300, 301} & set(clean)

    # The mix: shares of 1 and 2 of all words, neither above three times its source here.
    words = {s: sum(len(t.split()) for t, of in clean.values() if of == s) for s in "ab"}
    taken = collections.Counter(r["doc_id"] for r in got)
    assert set(taken) <= set(clean) and max(taken.values()) <= 3
    for source, share in (("a", 1), ("b", 2)):
        mixed = sum(n * len(clean[i][0].split()) for i, n in taken.items() if clean[i][1] == source)
        assert abs(mixed - share * sum(words.values()) / 3) <= max(len(t.split()) for t, _ in clean.values())

    # The shards: counts at most one apart, slots without a gap, sizes and sources of the documents.
    slots = collections.defaultdict(list)
    for r in got:
        text, source = clean[r["doc_id"]]
        assert (r["size"], r["source"]) == (len(text.encode()) + 8, source)
        slots[r["shard"]].append(r["slot"])
    counts = [len(slots[k]) for k in range(24)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
