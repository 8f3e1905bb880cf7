"""Every corpus query on the smallest tables, on odd rows and on empty tables."""

import os

import duckdb
import pytest

import corpus_pipeline
from chatprep.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
ALL = QUERIES | {"pipeline": corpus_pipeline.run}
#: Queries over other tables, whose odd rows are in test_llm_new.
ELSEWHERE = ("op12_conversation_trie", "op13_bitplane_clustering")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside, as columns of the input.
EXTRA = ", key string, digest bigint, doc string, size string, slot int, copies string, node string, nth int, words string, w string"

PLAIN = "the of and to in a is that it was for on are as with his they at be this have from or one had by"
GERMAN = "der die und in den von zu das mit sich des auf nicht ein eine als auch es an werden aus er hat"
LONG = " ".join(f"word{i % 977} {PLAIN}" for i in range(150))


def compared(database, df, sql):
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    result = database.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    return got, sorted(repr([r[names.index(c)] for c in columns]) for r in result.fetchall())


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@needs_tables
@pytest.mark.parametrize("name", list(ORACLE))
def test_same_as_sql(spark, database, name):
    got, want = compared(database, QUERIES[name](spark, FOLDER), ORACLE[name])
    assert got == want
    assert got


def odd_rows():
    copy = f"one two three {PLAIN} {GERMAN}"
    texts = [None, "", " \n\t ", "...", "12 34", "é", copy, copy, copy + " more", LONG, LONG, PLAIN, GERMAN, "\U0001f600 x" * 30, "a\x00b c"]
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", None, "s2"][i % 3]) for i, t in enumerate(texts)]
    rows += [rows[6], rows[6], (None, copy, "en", None), (None, None, None, None), (6, "same id, other text", "en", "s1")]
    rows += [(None, copy, "en", None)]
    return [(*r, None) for r in rows]


def write_tables(spark, folder, documents, extra=""):
    schema = DOCUMENTS + extra
    width = len(schema.split(", ")) - 5
    spark.createDataFrame([r + (None,) * width for r in documents], schema).write.parquet(f"{folder}/documents.parquet")
    items = [(0, "one two three " + " ".join(PLAIN.split()[:9])), (1, None), (None, GERMAN), (2, ""), (0, "den von zu"), (3, "word1 the of")]
    spark.createDataFrame(items if documents else [], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, None)]
    spark.createDataFrame(labels if documents else [], "doc_id bigint, quality bigint, toxic bigint").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([], "vec_id bigint, embedding array<float>").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("odd"), odd_rows(), EXTRA)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("nothing"), [])


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ELSEWHERE])
def test_odd_rows_give_one_row_each(spark, odd, name):
    rows = QUERIES[name](spark, odd).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((d is None, d or 0) for d, *_ in odd_rows())


@pytest.mark.parametrize("name", [n for n in ORACLE if n not in ("op1_jaccard_join", *ELSEWHERE)])
def test_odd_rows_same_as_sql(spark, odd, name):
    """Rows that share an id are one node of the join and several in its SQL, so op1 is left out."""
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd}/{table}.parquet/*.parquet'")
    got, want = compared(con, QUERIES[name](spark, odd), ORACLE[name])
    assert got == want


@pytest.mark.parametrize("name", list(ALL))
def test_empty_tables(spark, nothing, name):
    assert ALL[name](spark, nothing).collect() == []


def test_pipeline_on_odd_rows(spark, odd):
    rows = corpus_pipeline.run(spark, odd).collect()
    assert rows
    shards = [r["shard"] for r in rows]
    assert max(shards) < 24 and min(shards) == 0
    assert all(r["size"] > 8 for r in rows)  # texts without letters are gone
