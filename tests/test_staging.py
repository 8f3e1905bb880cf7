"""Staged tables go when they are released or when their block ends."""

import os

import pytest

from chatprep.plans.jobs import build_from_conversations, search
from chatprep.staging import release, stage, staged_tables, staging_folder


def stored(spark):
    return set(os.listdir(staging_folder(spark)))


def test_release_deletes_one_table(spark):
    before = stored(spark)
    one, two = (stage(spark.range(n), "numbers") for n in (3, 4))
    release(one)
    assert len(stored(spark) - before) == 1 and two.count() == 4
    release(two)
    assert stored(spark) == before


def test_block_deletes_all_but_what_is_kept(spark):
    before = stored(spark)
    with staged_tables() as outer:
        with staged_tables() as inner:
            stage(spark.range(2), "gone")
            kept = inner.keep(stage(spark.range(5), "kept"))
            release(stage(spark.range(6), "released"))
        assert len(stored(spark) - before) == 1 and kept.count() == 5
        last = outer.keep(stage(kept, "last"))
    assert len(stored(spark) - before) == 1 and last.count() == 5
    release(last)
    assert stored(spark) == before


def test_block_cleans_up_after_a_failure(spark):
    before = stored(spark)
    with pytest.raises(ValueError), staged_tables():
        stage(spark.range(2), "gone")
        raise ValueError
    assert stored(spark) == before


def test_jobs_leave_nothing_behind(spark, pairs, conversations, tmp_path):
    before = stored(spark)
    with staged_tables():
        queries = spark.createDataFrame([(1, "red tea")], "query_id int, text string")
        rows = pairs(("Where is red tea?", "In the hall."), ("Green?", "By the gate."))
        assert search(queries, rows.drop("system")).count() == 1
    talk = [("user", "a"), ("assistant", "b")]
    with staged_tables():
        built = build_from_conversations(conversations(talk, talk, [("user", "a"), ("assistant", "c")]), str(tmp_path), merge=True)
        assert built.kept.count() == 1
    assert stored(spark) == before
