import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from chatprep.functions.terms import WORD
from chatprep.functions.text import WHITESPACE
from chatprep.operators import counting, index as index_module, search as search_module
from chatprep.operators.index import asked_postings, build_index, document_frequency, spread_documents, term_counts
from chatprep.operators.search import asked_terms, search_documents, search_index
from chatprep.plans import queries as registered
from chatprep.sinks.writers import read_index, write_index
from test_retrieval import QUESTIONS, TEXTS, bag, found, ranking, table


def test_no_row_per_occurrence(spark):
    """Counting makes no row per n-gram, and a search without an index none per posting."""
    documents = table(spark, "doc_seq", TEXTS)
    plan = build_index(documents).postings._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow") == 1
    packed = asked_postings(spread_documents(documents)[0], {t: i for i, t in enumerate(bag(" ".join(TEXTS)))})
    assert packed.count() <= 2 * len(TEXTS)
    assert packed.selectExpr("explode(tid)").count() > 5 * len(TEXTS)


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_terms_sent_or_joined(spark, monkeypatch, sent):
    monkeypatch.setattr(search_module, "SENT_TERMS", sent)
    documents, questions = table(spark, "doc_seq", TEXTS), table(spark, "query_id", QUESTIONS)
    assert found(search_documents(questions, documents, 3)) == ranking(QUESTIONS, TEXTS, 3)


def _texts(seed, n):
    """Words of all lengths, astral and Japanese characters, every kind of blank, NUL."""
    dice = random.Random(seed)
    parts = ["a", "Bc", "d9e", "word", "ラーメン", "神", "ー", "\U0001f600", "\x00", " ", "　", "\x85", "\n", "é", "İ", "ß", "-"]
    return ["".join(dice.choices(parts, k=dice.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("piece, size", [(1, 8), (5, 40), (64, 1 << 20), (65_536, 100)])
def test_rows_of_one_document(spark, monkeypatch, piece, size):
    """Rows of the same or no number are one document, whatever batches and pieces they come in."""
    monkeypatch.setattr(index_module, "PIECE", piece)
    monkeypatch.setattr(counting, "TEXT_BYTES", size)
    texts = _texts(piece, 60)
    numbers = [None if i % 7 == 0 else i % 11 for i in range(60)]
    rows = spark.createDataFrame(list(zip(numbers, texts)), "doc_seq bigint, text string")
    want = {}
    for number, text in zip(numbers, texts):
        want.setdefault(number, Counter()).update(_bag(text))
    flat = {(d, t): n for d, b in want.items() for t, n in b.items()}
    index = build_index(rows)
    assert sorted((repr(k), n) for k, n in flat.items()) == sorted((repr((r["doc_seq"], r["term"])), r["tf"]) for r in index.postings.collect())
    df = {r["term"]: r["df"] for r in document_frequency(index.postings).collect()}
    assert df == Counter(t for b in want.values() for t in b)
    counted = term_counts(rows, "doc_seq", "text").collect()
    assert {(r["doc_seq"], r["term"]): r["tf"] for r in counted} == flat
    questions = table(spark, "query_id", QUESTIONS)
    assert found(search_documents(questions, rows, 4)) == found(search_index(questions, index, 4))


def _bag(text):
    low = "".join(" " if c in WHITESPACE else c for c in text.strip(WHITESPACE).lower())
    dense = low.replace(" ", "")
    grams = [dense[i : i + n] for n in (2, 3) for i in range(len(dense) - n + 1)]
    return Counter(re.findall(WORD, low) + grams)


@pytest.mark.parametrize("size", [1, 50, 1 << 21])
def test_blocks_hold_every_posting(spark, monkeypatch, size):
    """Blocks are the flat postings, each document in one of them; one row per term and block."""
    monkeypatch.setattr(counting, "BLOCK_POSTINGS", size)
    monkeypatch.setattr(counting, "TEXT_BYTES", 40)
    texts = _texts(3, 80)
    rows = spark.createDataFrame([(None if i % 9 == 0 else i % 31, t) for i, t in enumerate(texts)], "doc_seq bigint, text string")
    index = build_index(rows)
    # Put behind other rows: a block's part is one of the index all the same.
    blocks = index.blocks.limit(0).unionByName(index.blocks).collect()
    want = sorted((repr(r["doc_seq"]), r["term"], r["tf"]) for r in index.postings.collect())
    assert want == sorted((repr(d), r["term"], n) for r in blocks for d, n in zip(r["docs"], r["tfs"], strict=True))
    assert all(r["df"] == len(r["docs"]) and 0 <= r["part"] < index.parts for r in blocks)
    assert len({(r["term"], r["part"], r["block"]) for r in blocks}) == len(blocks)
    places = {}
    for r in blocks:
        for d in r["docs"]:
            places.setdefault(d, set()).add((r["part"], r["block"]))
    assert {len(p) for p in places.values()} == {1}
    counted = [(r["term"], r["df"]) for f in (index.postings, index.blocks) for r in document_frequency(f).collect()]
    assert len(counted) == 2 * len(set(counted))
    questions = table(spark, "query_id", QUESTIONS)
    assert found(search_documents(questions, rows, 4)) == found(search_index(questions, index, 4))


def test_no_row_per_posting(spark, tmp_path):
    """What is stored has a row per term and block, and a search moves those."""
    documents = table(spark, "doc_seq", ["tea near the station"] * 200)
    write_index(documents, str(tmp_path / "index"))
    stored, _ = read_index(spark, str(tmp_path / "index"))
    assert spark.read.parquet(str(tmp_path / "index" / "postings")).count() <= stored.parts * len(bag("tea near the station"))
    assert stored.postings.count() == 200 * len(bag("tea near the station"))
    plan = search_index(table(spark, "query_id", ["tea"]), stored, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "docs" in plan and "arrays_zip" not in plan


@pytest.mark.parametrize("size", [1, 50, 1 << 21])
def test_frequencies_are_counted_in_the_tasks(spark, monkeypatch, size):
    """A task gives a term's number of documents, whatever it sums up at a time; rows add up to the index's."""
    monkeypatch.setattr(counting, "BLOCK_POSTINGS", size)
    monkeypatch.setattr(counting, "TEXT_BYTES", 40)
    rows = [(None if i % 9 == 0 else i % 31, t) for i, t in enumerate(_texts(5, 80))]
    index = build_index(spark.createDataFrame(rows, "doc_seq bigint, text string"))
    want = Counter(t for n in {r[0] for r in rows} for t in {t for m, x in rows if m == n for t in _bag(x)})
    assert {r["term"]: r["df"] for r in document_frequency(index.frequencies).collect()} == want
    assert {r["term"]: r["df"] for r in index.term_stats.collect()} == want
    assert size < 100 or index.frequencies.count() <= index.parts * len(want)


@pytest.mark.parametrize("name", ["document_idf", "query_weights"])
def test_frequencies_make_no_lists(spark, name):
    """Who only asks how many documents have a term makes no lists of them."""
    plan = registered.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "docs" not in plan and "tfs" not in plan


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_statistics_of_asked_terms(spark, monkeypatch, sent):
    """Asked for terms, an index gives their statistics as they are among all, broadcast or joined."""
    monkeypatch.setattr(search_module, "SENT_TERMS", sent)
    rows = spark.createDataFrame([(None if i % 9 == 0 else i % 31, t) for i, t in enumerate(_texts(7, 80))], "doc_seq bigint, text string")
    asked = term_counts(table(spark, "query_id", ["word ラーメン", "word", "absent", ""]), "query_id", "text")
    terms = {r["term"] for r in asked.collect()}
    want = {r["term"]: (r["df"], r["idf"]) for r in build_index(rows).term_stats.collect() if r["term"] in terms}
    index = build_index(rows, asked_terms(asked))
    assert {r["term"]: (r["df"], r["idf"]) for r in index.term_stats.collect()} == want
    assert len(want) == index.term_stats.count() > 0 and "absent" in terms - want.keys()


def test_only_asked_terms_are_summed(spark):
    """Counts of terms that no question has go no further than the task that counted them."""
    plan = registered.QUERIES["query_weights"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sum(df") < plan.index("LeftSemi") < plan.index("MapInArrow")


def test_alphabets_of_any_size():
    """Alphabets of bytes, of numbers of 32 and of 64 bits, and windows of too many documents for these."""
    for seed, points in enumerate([60, 300, 3_000, 70_000]):
        dice = random.Random(seed)
        alphabet = [chr(c) for c in range(0x30, 0x30 + points) if not 0xD800 <= c < 0xE000]
        texts = ["".join(dice.choices(alphabet, k=dice.randint(0, 16))).lower() for _ in range(9_000)]
        batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["doc_seq", "_text"])
        rows = [r for b in counting.counted_terms(["doc_seq"], 65_536, False)([batch]) for r in b.to_pylist()]
        assert {(r["doc_seq"], r["term"]): r["tf"] for r in rows} == {(i, t): n for i, x in enumerate(texts) for t, n in _bag(x).items()}
        assert len(rows) == sum(len(_bag(x)) for x in texts)
