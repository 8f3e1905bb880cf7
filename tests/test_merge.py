from collections import OrderedDict

import pytest

from chatprep.functions.answers import ANSWERS_HEADER, SHOPS_HEADER
from chatprep.operators.merge import (
    MERGED_FROM,
    merge_pairs,
    merge_same_user,
    merge_same_user_pairs,
)
from chatprep.operators.normalize import with_default_system
from chatprep.operators.quality import validate_conversations
from conftest import by_seq, talks


def shop(name, feature="", url=""):
    return f"「{name}」" + (f"（特徴：{feature}）" if feature else "") + (f" {url}" if url else "")


def merged(df):
    return {r["user"]: r["assistant"] for r in merge_pairs(df).rows.collect()}


def test_formats(pairs):
    rows = pairs(
        ("eat?", "A is good."),
        ("eat?", "B is good."),
        ("shop?", shop("X", "cheap", "https://x.example/1")),
        ("eat?", "C is good."),
        ("shop?", shop(" Y ")),
        ("same?", shop("X", "one")),
        ("same?", shop("X", "two")),
        ("once?", "A"),
        ("once?", "A"),
        ("once?", ""),
        ("blank?", ""),
        ("half?", shop("X")),
        ("half?", "no name"),
        ("space?", shop(" ")),
        ("space?", shop("Z")),
    )
    assert merged(rows) == {
        "eat?": f"{ANSWERS_HEADER}\n1. A is good.\n2. B is good.\n3. C is good.",
        "shop?": f"{SHOPS_HEADER}\n1. X（特徴：cheap）\n   地図: https://x.example/1\n2. Y",
        "same?": f"{ANSWERS_HEADER}\n1. {shop('X', 'one')}\n2. {shop('X', 'two')}",
        "once?": "A",
        "blank?": "",
        "half?": f"{ANSWERS_HEADER}\n1. {shop('X')}\n2. no name",
        "space?": f"{SHOPS_HEADER}\n1. \n2. Z",
    }


def test_url_ends_at_wide_space(pairs):
    rows = pairs(("q", shop("A", "", "https://a.example\u3000more")), ("q", shop("B")))
    assert merged(rows)["q"] == f"{SHOPS_HEADER}\n1. A\n   地図: https://a.example\n2. B"


def test_counters(pairs):
    rows = pairs(("q", "A"), ("q", "B"), ("q", ""), ("q", "A"), ("r", "A"), ("r", "A"))
    assert tuple(merge_pairs(rows).stats.first()) == (1, 4, 2)


def test_conversations(conversations):
    data = conversations(
        [("user", "q"), ("assistant", "A")],
        [("user", "q"), ("assistant", "A"), ("user", "more"), ("assistant", "B")],
        [("user", "q"), ("assistant", "B")],
        None,
        [("system", "s"), ("user", "q"), ("assistant", "C")],
        [("system", ""), ("user", "r"), ("assistant", "D")],
    )
    got = merge_same_user(data)
    assert talks(got.rows) == {
        1: [("user", "q"), ("assistant", "A"), ("user", "more"), ("assistant", "B")],
        3: None,
        MERGED_FROM: [("user", "q"), ("assistant", f"{ANSWERS_HEADER}\n1. A\n2. B")],
        MERGED_FROM + 4: [("system", "s"), ("user", "q"), ("assistant", "C")],
        MERGED_FROM + 5: [("user", "r"), ("assistant", "D")],
    }
    assert tuple(got.stats.first()) == (1, 2, 5)
    # Merging mends what would be rejected: an empty system message is dropped.
    assert by_seq(validate_conversations(data), "problems")[5]
    assert not by_seq(validate_conversations(got.rows), "problems")[MERGED_FROM + 5]
    with_system = merge_same_user(with_default_system(data, "d"), "d").rows
    assert talks(with_system)[MERGED_FROM + 5][0] == ("system", "d")


def test_table_variant(pairs):
    unique = pairs(("q", "A"), ("r", " "), (" q2 ", "A"))
    assert merge_same_user_pairs(unique).rows.count() == 3
    assert merge_same_user_pairs(unique.drop("system")).rows.columns == ["seq", "user", "assistant"]
    repeated = pairs(("q", "A"), (" q ", "B"), ("r", " "))
    result = merge_same_user_pairs(repeated)
    assert result.rows.columns == ["seq", "user", "assistant"]
    assert [tuple(r) for r in result.rows.collect()] == [(0, "q", f"{ANSWERS_HEADER}\n1. A\n2. B")]
    named = pairs(("s", "q", "A"), ("s", "q", "B"))
    assert merge_same_user_pairs(named).rows.columns == ["seq", "user", "assistant", "system"]


@pytest.mark.parametrize("kind", ["plain", "shops"])
def test_one_group_of_many_answers_with_sparse_order(spark, kind):
    """Every answer of a large group is in its row, whatever the order values are."""
    make = (lambda i: shop(f"n{i}", f"f{i}")) if kind == "shops" else (lambda i: f"answer {i}")
    rows = [(i * 1_000_003, None, "hot", make(i % 700)) for i in range(3000)] + [(1, None, "cool", "x")]
    data = spark.createDataFrame(rows, "seq bigint, system string, user string, assistant string").repartition(7)
    got = {r["user"]: r["assistant"].split("\n") for r in merge_pairs(data).rows.collect()}
    numbered = [line for line in got["hot"][1:] if line[0].isdigit()]
    assert len(numbered) == 700 and numbered[699].startswith("700. ")
    assert got["cool"] == ["x"]
    assert tuple(merge_pairs(data).stats.first()) == (1, 3000, 2)


def test_a_group_no_cell_can_hold_is_named(pairs, monkeypatch):
    monkeypatch.setattr("chatprep.operators.groups.CELL_CHARS", 100)
    with pytest.raises(Exception, match="group 0 has .* characters"):
        merge_pairs(pairs(("hot", "a" * 90), ("hot", "b" * 90))).rows.collect()


def test_any_order_value_can_be_merged(spark):
    last = (1 << 63) - 1
    rows = [
        (last, [("user", "q"), ("assistant", "A")]),
        (-5, [("user", "q"), ("assistant", "B")]),
        (last - 1, [("user", "x"), ("assistant", "y"), ("user", "z"), ("assistant", "w")]),
    ]
    data = spark.createDataFrame(rows, "seq bigint, messages array<struct<role:string,content:string>>")
    got = [r["messages"][0]["content"] for r in merge_same_user(data).rows.orderBy("seq").collect()]
    assert got == ["x", "q"]


def test_merging_twice_changes_nothing(pairs):
    data = pairs(("q", "A"), ("q", "B"), ("r", "A"))
    once = merge_pairs(data).rows
    assert {tuple(r) for r in merge_pairs(once).rows.collect()} == {tuple(r) for r in once.collect()}
