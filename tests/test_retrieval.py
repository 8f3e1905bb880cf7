import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chatprep.operators import grid, groups, index as index_module
from chatprep.operators import search as search_module
from chatprep.operators.documents import build_documents, extract_category
from chatprep.operators.index import (
    build_index,
    spread_documents,
    term_counts,
    tokenize_terms,
)
from chatprep.operators.search import (
    NOTHING_FOUND,
    answer_queries,
    attach_documents,
    build_prompts,
    few_hits,
    make_context,
    score_documents,
    search_documents,
    search_index,
    top_k,
)
from chatprep.plans.jobs import save_index, search, search_saved
from chatprep.sinks.writers import read_index, write_index

TEXTS = [
    "ab",
    "a",
    "a b",
    "",
    " \u3000",
    "Hello  World 42",
    "神戸で ラーメン\nを食べるなら？",
    "x\U0001f600y\U0001f600z",
    "-- --",
    "ÀÉ straße ΑΣ",
    "long text " * 40,
]
QUESTIONS = ["hello world", "ラーメン", "☆", "text", "b a"]


def bag(text):
    low = text.strip().lower()
    dense = "".join(low.split())
    grams = [dense[i : i + n] for n in (2, 3) for i in range(len(dense) - n + 1)]
    return Counter(re.findall(r"[a-z0-9]+|[ぁ-んァ-ン一-龥ー]+", low) + grams)


def ranking(questions, texts, k):
    bags = [bag(t) for t in texts]
    df = Counter(t for b in bags for t in b)
    out = {}
    for q, question in enumerate(questions):
        scored = []
        for d, b in enumerate(bags):
            score = sum(
                n * (1 + math.log(b[t])) * (math.log((len(texts) + 1) / (df[t] + 0.5)) + 1)
                for t, n in bag(question).items()
                if t in b
            )
            if score > 0:
                scored.append((-round(score, 9), d))
        out.update({(q, r): (d, round(-s, 6)) for r, (s, d) in enumerate(sorted(scored)[:k], 1)})
    return out


def table(spark, key, texts):
    return spark.createDataFrame(list(enumerate(texts)), f"{key} bigint, text string")


def found(hits):
    return {(r["query_id"], r["rank"]): (r["doc_seq"], round(r["score"], 6)) for r in hits.collect()}


@pytest.mark.parametrize("piece", [1, 2, 3, 65_536])
def test_terms(spark, monkeypatch, piece):
    monkeypatch.setattr(index_module, "PIECE", piece)
    got = term_counts(table(spark, "doc", TEXTS), "doc", "text")
    counted = {(r["doc"], r["term"]): r["tf"] for r in got.collect()}
    assert counted == {(i, t): n for i, x in enumerate(TEXTS) for t, n in bag(x).items()}
    assert counted[(0, "ab")] == 2 and counted[(2, "ab")] == 1
    listed = tokenize_terms(table(spark, "doc", TEXTS[:6]), "doc", "text")
    assert listed.count() == sum(sum(bag(x).values()) for x in TEXTS[:6])


@pytest.mark.parametrize("partitions", [1, 7])
def test_search_matches_brute_force(spark, partitions):
    documents = table(spark, "doc_seq", TEXTS).repartition(partitions)
    questions = table(spark, "query_id", QUESTIONS)
    want = ranking(QUESTIONS, TEXTS, 3)
    assert found(search_documents(questions, documents, 3)) == want
    assert found(search_index(questions, build_index(documents), 3)) == want
    assert found(search_documents(questions, documents, 0)) == {}


@pytest.mark.parametrize("weights, entries, tasks", [(4, 1 << 20, 1000), (1 << 18, 3, 1000), (7, 40, 3)])
def test_many_blocks_and_small_cells(spark, monkeypatch, weights, entries, tasks):
    """Queries in several blocks and groups; documents in steps of a few; cells that share a task."""
    monkeypatch.setattr(grid, "MOST_TASKS", tasks)
    monkeypatch.setattr(search_module, "BLOCK_WEIGHTS", weights)
    monkeypatch.setattr(grid, "ENTRIES", entries)
    documents = table(spark, "doc_seq", TEXTS)
    questions = table(spark, "query_id", QUESTIONS)
    want = ranking(QUESTIONS, TEXTS, 3)
    assert found(search_documents(questions, documents, 3)) == want
    assert found(search_index(questions, build_index(documents), 3)) == want


def test_every_document_as_a_query(spark):
    texts = [f"{t} {i % 4}" for i, t in enumerate(TEXTS * 3)]
    documents = table(spark, "doc_seq", texts).withColumn("doc_seq", F.col("doc_seq").cast("decimal(38,0)"))
    questions = table(spark, "query_id", texts).withColumn("query_id", F.concat(F.lit("q"), "query_id"))
    got = {(int(q[1:]), r): (int(d), s) for (q, r), (d, s) in found(search_documents(questions, documents, 4)).items()}
    assert got == ranking(texts, texts, 4)


def test_all_pairs_without_a_limit(spark):
    documents, questions = table(spark, "doc_seq", TEXTS), table(spark, "query_id", QUESTIONS)
    index = build_index(documents)
    terms = term_counts(questions, "query_id", "text")
    scores = score_documents(terms, index.postings, index.term_stats)
    assert found(top_k(scores, 100)) == ranking(QUESTIONS, TEXTS, 100)
    assert scores.count() == len(ranking(QUESTIONS, TEXTS, 100))


def test_a_stored_index_is_pruned(spark, tmp_path):
    """Both tables are filtered by partition, and few terms read few files."""
    texts = [f"{w} {w * 2}" for w in ("alpha", "beta", "gamma", "delta", "omega") for _ in range(9)]
    documents = table(spark, "doc_seq", texts)
    write_index(documents, str(tmp_path / "index"), bucket_rows=16)
    stored, _ = read_index(spark, str(tmp_path / "index"))
    assert stored.buckets > 20
    files = {}
    for name, asked in (("few", ["beta"]), ("many", texts)):
        questions = table(spark, "query_id", asked)
        terms = search_module.numbered_terms(term_counts(questions, "query_id", "text"))
        pruned = stored.of_terms(terms)
        for df in pruned[:2]:
            filters = re.search(r"PartitionFilters: \[([^]]*)\]", df._jdf.queryExecution().executedPlan().toString())
            assert "bucket" in filters[1]
        files[name] = pruned.postings.select(F.input_file_name()).distinct().count()
        assert found(search_index(questions, stored, 3)) == ranking(asked, texts, 3)
    assert files["few"] < files["many"] / 2


def test_hits_are_broadcast_only_when_few(spark):
    questions = table(spark, "query_id", QUESTIONS)
    assert few_hits(questions, 6) and few_hits(questions, 0) and not few_hits(questions, 100_000)
    documents = table(spark, "doc_seq", TEXTS).withColumn("title", F.lit("t"))
    hits = search_documents(questions, documents, 2)
    for small in (True, False):
        plan = attach_documents(hits, documents, small=small)._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=broadcast" in plan.split("Join")[1]) == small


def test_hot_keys_are_split_and_joined_whole(spark):
    many = spark.createDataFrame(
        [("hot" if i % 2 else f"k{i % 9}", i) for i in range(400)], "key string, i bigint"
    )
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("none", 4)], "key string, j bigint")
    counts = many.groupBy("key").count()
    hot = groups.hot_keys(counts, "key", "count", 10)
    assert {r["key"]: r["_salts"] for r in hot.collect()}["hot"] == 5
    got = groups.salted_join(many, few, "key", "i", hot)
    assert sorted(got.collect()) == sorted(many.join(few, "key").collect())


def test_more_tasks_for_longer_texts(spark):
    documents = table(spark, "doc_seq", TEXTS)
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spread_documents(documents)[1] == at_least
    assert spread_documents(documents, 10)[1] == -(-sum(map(len, TEXTS)) // 10)


def test_ties_keep_document_order(spark):
    scores = spark.createDataFrame(
        [(1, 7, 2.0), (1, 3, 2.0 + 1e-12), (1, 5, 2.0), (1, 9, 3.0)],
        "query_id bigint, doc_seq bigint, score double",
    )
    got = {r["rank"]: r["doc_seq"] for r in top_k(scores, 3).collect()}
    assert got == {1: 9, 2: 3, 3: 5}
    with pytest.raises(ValueError):
        top_k(scores, -1)


SHOPS = [
    ("神戸でラーメンを食べるなら？", "「麺屋」はどうですか（特徴：濃厚）"),
    ("What?", "Plain answer"),
    ("おすすめの和食のお店は？", "「麺屋」 https://map.example/1\u3000です"),
    ("寿司が食べたい", "「 」 blank name"),
    ("人気のカフェのお店", "「茶房」（特徴：静か）https://map.example/2"),
    ("神戸で\nパンを食べるなら", "「茶房」"),
]


def test_documents(pairs):
    got = {r["doc_seq"]: r for r in build_documents(pairs(*SHOPS)).collect()}
    assert set(got) == {0, 1, 3, 4}
    ramen = got[0]
    assert ramen["title"] == "麺屋" and ramen["categories"] == ["ラーメン", "和食"]
    assert (ramen["feature"], ramen["url"]) == ("濃厚", "https://map.example/1")
    assert ramen["answer"] == SHOPS[0][1]
    assert ramen["text"] == "\n".join(
        ["麺屋", "ラーメン 和食", "濃厚", "https://map.example/1", SHOPS[0][0] + " " + SHOPS[2][0], SHOPS[0][1]]
    )
    assert got[1]["text"] == "What?\nWhat?\nPlain answer"
    assert got[3]["title"] == "寿司が食べたい" and got[3]["categories"] == ["寿司"]
    assert got[4]["url"] == "https://map.example/2" and got[4]["categories"] == ["カフェ"]


def test_first_matching_pattern_decides(spark):
    questions = ["おすすめの \u3000のお店 寿司が食べたい", "神戸でAを食べるなら人気のBのお店", "none", "a\nbが食べたい"]
    rows = spark.createDataFrame([(q,) for q in questions], "q string")
    got = [r["category"] for r in extract_category(rows, "q").collect()]
    assert got == ["", "A", "", "b"]


def test_one_document_of_many_questions(pairs, spark):
    """A name that most rows share keeps all of its questions in its text."""
    hot = [(f"q{i} 人気の{'カフェ' if i % 2 else 'パン'}のお店", "「hot」 answer" + "!" * (i % 3)) for i in range(2000)]
    documents = build_documents(pairs(*hot, *SHOPS).repartition(5))
    text = documents.filter("doc_seq = 0").first()["text"]
    assert all(q in text for q, _ in hot[::97]) and text.count("人気") == 2000
    assert documents.filter("text IS NULL").count() == 0
    questions = table(spark, "query_id", ["q1999 人気"])
    assert found(search_documents(questions, documents, 3)) == found(search_index(questions, build_index(documents), 3))


def test_context_prompt_and_fallback(pairs, spark, tmp_path):
    data = pairs(*SHOPS).select("seq", "user", "assistant")
    questions = table(spark, "query_id", ["麺屋 濃厚", "☆☆"])
    documents = build_documents(data)
    hits = search_documents(questions, documents, 1)
    contexts = make_context(attach_documents(hits, documents, small=True))
    want = (
        "[1] 麺屋\nジャンル: ラーメン, 和食\n特徴: 濃厚\n地図: https://map.example/1\n元データ: " + SHOPS[0][1]
    )
    assert {r["query_id"]: r["context"] for r in contexts.collect()} == {0: want}
    answers = {r["query_id"]: r["answer"] for r in answer_queries(questions, contexts).collect()}
    assert answers == {0: want, 1: NOTHING_FOUND}
    prompt = build_prompts(questions, contexts, "sys", "{context}|{query}|").collect()
    assert [[tuple(m) for m in r["messages"]] for r in prompt] == [
        [("system", "sys"), ("user", f"{want}|麺屋 濃厚|")]
    ]
    assert {r["answer"] for r in search(questions, data, top_k=1).collect()} == set(answers.values())
    save_index(data, str(tmp_path / "index"))
    stored = search_saved(spark, str(tmp_path / "index"), questions, top_k=1)
    assert {r["answer"] for r in stored.collect()} == set(answers.values())
    assert search(questions, data, top_k=1, prompts=True).count() == 1


def test_two_hits_make_two_blocks(pairs, spark):
    documents = build_documents(pairs(("q1 tea", "a1"), ("q2 tea", "a2")))
    questions = table(spark, "query_id", ["tea"])
    found_rows = attach_documents(search_documents(questions, documents), documents, small=False)
    assert make_context(found_rows).first()["context"] == (
        "[1] q1 tea\n元データ: a1\n\n[2] q2 tea\n元データ: a2"
    )
