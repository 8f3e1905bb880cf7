"""Substring dedup against counting all windows."""

import hashlib
import random
from collections import Counter

import pytest

from chatprep.llm import substring_dedup
from chatprep.llm.substring_dedup import remove_repeats


def brute(rows, length):
    words = [(i, (t or "").split()) for i, t in rows]
    seen = Counter(tuple(w[s : s + length]) for _, w in words for s in range(len(w) - length + 1))
    out = []
    for i, w in words:
        gone = {p for s in range(len(w) - length + 1) if seen[tuple(w[s : s + length])] > 1 for p in range(s, s + length)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [draw.choices(vocabulary, k=k) for k in (11, 12, 13, 30, 80)]
    rows = []
    for i in range(60):
        words = draw.choices(vocabulary, k=draw.randrange(0, 60))
        for _ in range(draw.randrange(0, 3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = draw.choice(passages)
        if draw.random() < 0.15:
            words += ["der"] * draw.randrange(5, 40)
        rows.append((i, " ".join(words)))
    rows += [rows[3], (100, rows[3][1]), (101, None), (102, ""), (None, rows[4][1]), (None, rows[5][1]), (None, None), (7, "same id")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("group", [2000, 3])
def test_same_as_counting(spark, monkeypatch, seed, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc bigint, text string").repartition(4)
    got = [(r["doc"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(docs, 12).collect()]
    assert sorted(got, key=repr) == brute(rows, 12)


def test_a_very_long_text_that_repeats_itself(spark):
    text = " ".join(f"a{i % 5000}" for i in range(12000))
    row = remove_repeats(spark.createDataFrame([(1, text)], "doc bigint, text string"), 35).collect()[0]
    assert (row["n_words"], row["n_removed"]) == (12000, 12000)


def test_texts_that_share_an_id_and_a_prefix(spark, monkeypatch):
    """One text is in a large group, the other in a small one, at the same places of one id."""
    monkeypatch.setattr(substring_dedup, "GROUP", 3)
    often, twice = (" ".join(f"{a}{i}" for i in range(12)) for a in "xy")
    rows = [(i, often) for i in range(6)] + [(7, often), (7, twice), (8, twice)]
    got = [(r["doc"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(spark.createDataFrame(rows, "doc bigint, text string"), 12).collect()]
    assert sorted(got, key=repr) == brute(rows, 12)
    assert all(r[2] == 12 for r in got)


def test_query_against_counting(spark, tmp_path):
    rows = corpus(5) + [(300, " ".join(f"r{i % 900}" for i in range(100_000)))]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = substring_dedup.op2_substring_dedup(spark, str(tmp_path)).collect()
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute(rows, 35)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
