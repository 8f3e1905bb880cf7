import re

import pytest
from pyspark.sql import functions as F

from chatprep.functions import conversations as c
from chatprep.operators import quality
from chatprep.operators.quality import (
    dedup_conversations,
    duplicate_rows,
    flag_too_long,
    reject_unusable,
    split_valid,
    tag_conversations,
    validate_conversations,
)
from chatprep.operators.stats import dataset_stats, run_counters, size_guidance, with_lengths
from chatprep.staging import stage
from conftest import by_seq, talks

U, A = ("user", "u"), ("assistant", "a")


def empty(role):
    return f"empty {role} message / {role} の中身が空です"


def unknown(role):
    return f"unknown role '{role}' / 不明なrole"


def test_problems_in_order(conversations):
    data = conversations(
        [],
        [("system", "s")],
        [("bot", "x"), A],
        [U, ("assistant", "")],
        [A, U],
        [U, A, U],
        [U, U, A, A],
        [U, ("system", "s"), A, ("system", "t")],
        [U, A],
        [("bot", ""), ("user", "")],
        [("system", ""), U, A],
        None,
    )
    assert by_seq(validate_conversations(data), "problems") == {
        0: [c.EMPTY_CONVERSATION],
        1: [c.NO_TURNS],
        2: [unknown("bot"), c.MUST_START_WITH_USER, c.MUST_ALTERNATE],
        3: [empty("assistant")],
        4: [c.MUST_START_WITH_USER, c.MUST_END_WITH_ASSISTANT, c.MUST_ALTERNATE],
        5: [c.MUST_END_WITH_ASSISTANT],
        6: [c.MUST_ALTERNATE],
        7: [],
        8: [],
        9: [
            unknown("bot"),
            empty("bot"),
            empty("user"),
            c.MUST_START_WITH_USER,
            c.MUST_END_WITH_ASSISTANT,
            c.MUST_ALTERNATE,
        ],
        10: [empty("system")],
        11: [c.NO_PAIR],
    }


def test_rejects_name_first_problem(conversations):
    kept, rejects = split_valid(validate_conversations(conversations([U, A], [("bot", ""), A], None)))
    assert set(talks(kept)) == {0}
    assert by_seq(rejects, "reason") == {1: unknown("bot"), 2: c.NO_PAIR}
    usable, unusable = reject_unusable(conversations([U, A], None))
    assert set(talks(usable)) == {0} and by_seq(unusable, "reason") == {1: c.NO_PAIR}


@pytest.mark.parametrize("partitions", [1, 7])
def test_first_copy_stays(conversations, partitions):
    data = conversations([U, A], [A], [U, A], [U, ("assistant", "b")], [A], [U, A])
    tagged = tag_conversations(validate_conversations(data.repartition(partitions)))
    kept = tagged.filter(F.col("reason").isNull())
    assert by_seq(kept, "copies") == {0: 3, 3: 1}
    counts = run_counters(tagged).first()
    assert tuple(counts) == (6, 2, 2)
    good, _ = split_valid(validate_conversations(data))
    once = dedup_conversations(good)
    assert by_seq(once, "copies") == {0: 3, 3: 1}
    assert set(by_seq(duplicate_rows(good), "seq")) == {2, 5}
    assert by_seq(dedup_conversations(once.drop("copies")), "copies") == {0: 1, 3: 1}


def test_above_the_limit_texts_are_grouped(conversations):
    data = conversations([U, A], [A], [U, A], [U, ("assistant", "b")], [A], [U, A], [U, ("assistant", "b")])
    good, _ = split_valid(validate_conversations(data))
    for limit in (0, 1, 2):
        tagged = tag_conversations(validate_conversations(data), limit)
        assert by_seq(tagged, "reason", "copies") == {0: (None, 3), 3: (None, 2), 1: (c.MUST_START_WITH_USER, 1), 4: (c.MUST_START_WITH_USER, 1)}
        assert by_seq(dedup_conversations(good, limit), "copies") == {0: 3, 3: 2}


def test_only_digests_are_shuffled(conversations, monkeypatch):
    """The texts are read in place; what is exchanged is a digest, a number and a count."""
    good, _ = split_valid(validate_conversations(conversations([U, A], [U, A], [U, ("assistant", "b")])))
    plans = []
    monkeypatch.setattr(quality, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or stage(df, name))
    plans.append(dedup_conversations(good)._jdf.queryExecution().executedPlan().toString())
    assert sum("Exchange hashpartitioning(_digest" in p for p in plans) == 1
    for text in plans:
        assert not re.search(r"Exchange hashpartitioning\((?!_digest)", text) and "Exchange rangepartitioning" not in text
        if "Exchange hashpartitioning(_digest" in text:
            assert "messages" not in text


def test_stats(conversations):
    data = conversations(*[[("user", "x" * n)] for n in (1, 2, 3, 4)])
    got = dataset_stats(data).first()
    assert (got["count"], got["avg_chars"], got["median_chars"], got["max_chars"]) == (4, 2, 3, 4)
    assert (got["avg_tokens"], got["max_tokens"]) == (0, 1)
    assert set(dataset_stats(data.limit(0)).first()) == {0}
    assert tuple(run_counters(tag_conversations(validate_conversations(data.limit(0)))).first()) == (0, 0, 0)


def test_tokens_round_down_per_message(conversations):
    data = conversations([("user", "abc"), ("assistant", "abcde")], [("user", "日本"), ("x", "\U0001f600")])
    assert by_seq(with_lengths(data), "chars", "tokens") == {0: (8, 1), 1: (3, 3)}
    assert by_seq(flag_too_long(data, 1), "too_long") == {0: False, 1: True}


def test_guidance(spark):
    stats = spark.createDataFrame(
        [(n, 1025) for n in (0, 9, 10, 29, 30, 60, 61, 100, 300, 301, 500)],
        "count bigint, max_tokens bigint",
    )
    got = [(r["count"], r["level"], r["epochs"]) for r in size_guidance(stats).collect()]
    assert got == [
        (0, "error", None),
        (9, "barely changes", None),
        (10, "small", None),
        (29, "small", None),
        (30, "ok", "8-10"),
        (60, "ok", "8-10"),
        (61, "ok", None),
        (100, "ok", "4-6"),
        (300, "ok", "4-6"),
        (301, "ok", None),
        (500, "ok", "2-3"),
    ]
    assert size_guidance(stats).first()["over_length"]
    assert not size_guidance(stats, 1025).first()["over_length"]
