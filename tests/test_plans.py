"""What must not appear in a plan that is to hold at any size."""

import re

import pytest

from chatprep.operators.search import search_documents
from chatprep.plans import queries as q

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["conversations_checked", "dedup_kept", "counters", "dataset_statistics", "merged_conversations",
     "knowledge_documents", "json_shapes", "document_idf"],
)
def test_no_python_rows_cartesian_or_single_task_windows(spark, name):
    text = plan(q.QUERIES[name](spark, FOLDER))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "windowspecdefinition(ROW" not in text
    for window in re.findall(r"windowspecdefinition\(([^,]*),", text):
        assert " ASC" not in window and " DESC" not in window  # a partition key comes first


@pytest.mark.parametrize("name", ["search_topk", "search_context"])
def test_searches_have_no_cartesian_or_single_task_windows(spark, name):
    text = plan(q.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "windowspecdefinition(ROW" not in text


def test_search_scores_and_ranks_in_cells(spark):
    hits = search_documents(q._questions(spark, FOLDER), q._documents(spark, FOLDER))
    text = plan(hits)
    # Above the cells only ranked hits move; below them weights and postings, once.
    above, below = text.split("MapInArrow")
    assert above.count("Exchange") == 1 and "WindowGroupLimit" in above
    assert below.count("Exchange") == 1 and "BatchEval" not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(q._documents(spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_json_is_parsed_once(spark):
    from chatprep.operators.normalize import normalize_conversations

    records = spark.createDataFrame([(0, "{}")], "seq bigint, raw string")
    plan = normalize_conversations(records, "s")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("fromjson") <= 5
    assert plan.count("try_parse_json") + plan.count("parseJson") <= 1
