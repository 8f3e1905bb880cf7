"""The Jaccard join against all pairs on small corpora."""

import random

import pytest

from chatprep.llm import jaccard_join
from chatprep.llm.components import connected_components
from chatprep.llm.jaccard_join import jaccard_classes, near_duplicate_stage, ngram_set, slice_hashes


def brute(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))} if w else set()
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed):
    """Groups of edited copies of all degrees, chains of them, shared passages and short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=25)
    texts = []
    for _ in range(8):
        base = draw.choices(vocabulary, k=draw.choice([6, 12, 40, 90, 150]))
        for _ in range(draw.choice([1, 5, 14])):
            copy = list(base)
            for _ in range(draw.choice([0, 1, 1, 2, 3, 5, 9])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(copy)
            if draw.random() < 0.3:
                base = copy
    texts += [passage + draw.choices(vocabulary, k=draw.choice([3, 20])) for _ in range(15)]
    texts += [draw.choices(vocabulary[:3], k=draw.randrange(1, 5)) for _ in range(20)]
    draw.shuffle(texts)
    return [(i * 3, " ".join(t)) for i, t in enumerate(texts)] + [(1, None), (2, " "), (4, "W1 w2"), (5, "w1  W2")]


def classes(spark, rows, n, num, den):
    docs = spark.createDataFrame(rows, "doc bigint, text string").repartition(5)
    sizes, found = jaccard_classes(docs, n, num, den)
    root = {r["node"]: r["component"] for r in found.collect()}
    return {r["doc"]: (r["size"], root.get(r["doc"], r["doc"])) for r in sizes.collect()}


@pytest.mark.parametrize("n, num, den", [(3, 90, 100), (5, 8, 10), (2, 7, 10)])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed, n, num, den):
    rows = corpus(seed)
    assert classes(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_small_blocks_and_salts(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    monkeypatch.setattr(jaccard_join, "WINDOW", 3)
    monkeypatch.setattr(jaccard_join, "SALT", 3)
    monkeypatch.setattr(jaccard_join, "BATCH", 7)
    rows = corpus(3)
    assert classes(spark, rows, 3, 85, 100) == brute(rows, 3, 85, 100)


def by_tag(grams):
    """tag -> (hashes, how many can be left out)"""
    hashes, spares = slice_hashes(grams, 8, 10)
    bits = jaccard_join.TAG_BITS
    low = (1 << bits) - 1
    return {s & low: ({h for h in hashes.tolist() if h & low == s & low}, s >> bits) for s in spares}


def test_linked_sets_share_more_slices_than_they_can_spare():
    draw = random.Random(5)
    linked = 0
    for _ in range(3000):
        words = [f"v{draw.randrange(10**6)}" for _ in range(draw.choice([draw.randrange(1, 12), draw.randrange(1, 120)]))]
        other = list(words)
        for _ in range(draw.randrange(0, 4)):
            other[draw.randrange(len(other))] = "x"
        other = other[: draw.randrange(max(1, len(other) - 8), len(other) + 1)]
        a, b = (ngram_set(" ".join(w).encode(), 1) for w in (words, other))
        common, union = len({*a.tolist()} & {*b.tolist()}), len({*a.tolist()} | {*b.tolist()})
        if 10 * common >= 8 * union:
            linked += 1
            mine, yours = by_tag(a), by_tag(b)
            assert any(len(mine[t][0] & yours[t][0]) > max(mine[t][1], yours[t][1]) for t in mine.keys() & yours.keys())
    assert linked > 500


def test_unrelated_short_sets_do_not_meet():
    draw = random.Random(6)
    seen, again = set(), 0
    for _ in range(4000):
        grams = ngram_set(" ".join(f"v{draw.randrange(10**9)}" for _ in range(draw.randrange(3, 30))).encode(), 1)
        mine = set(slice_hashes(grams, 8, 10)[0].tolist())
        again += len(mine & seen)
        seen |= mine
    assert again == 0


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_stage_keeps_one_of_each_class(spark):
    text = " ".join(f"t{i}" for i in range(60))
    rows = [(1, text, "x"), (2, text + " end", "y"), (2, text + " end", "y"), (3, "other words here and there", "z"), (3, "other words here and there", "z")]
    rows += [(None, text, "n"), (4, None, "e"), (5, None, "e"), (3, "same id", "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, near_node string")
    out = near_duplicate_stage(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"] or -1), r["text"] or "") for r in out.collect())
    assert got == [(-1, text), (1, text), (3, "other words here and there"), (3, "same id"), (4, ""), (5, "")]
