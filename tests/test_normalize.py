from chatprep.operators.normalize import (
    messages_to_pairs,
    messages_to_sharegpt,
    non_pairs,
    normalize_conversations,
    pairs_to_messages,
    resolve_columns,
    sharegpt_to_messages,
    with_default_system,
)
from conftest import by_seq, talks

HI = [("user", "hi"), ("assistant", "yo")]


def chat(*turns):
    return {"messages": [{"role": r, "content": c} for r, c in turns]}


def test_json_shapes(json_records):
    got = talks(
        normalize_conversations(
            json_records(
                chat((" User ", " hi "), ("ASSISTANT", "yo\u3000")),
                {"messages": [{"role": "user", "content": "hi"}, 5, "x", None, {"role": "assistant"}]},
                {"messages": []},
                {"conversations": [
                    {"from": "Human", "value": "hi"},
                    {"from": "tool", "value": "dropped"},
                    {"from": " gpt ", "value": " yo"},
                ]},
                {"conversations": [None, [], {"from": "system", "value": "s"}]},
                {"messages": "[1]", "user": "hi", "assistant": "yo"},
                {"question": "hi", "output": "yo"},
                {"prompt": None, "Completion": "x"},
                {"user": "hi"},
                [1, 2],
                5,
                '"text"',
                {"user": "hi", "assistant": "yo", "Persona": " be kind "},
                {"user": "hi", "assistant": "yo", "system": "  "},
                chat(("user", 1.5), ("assistant", True)),
                {"input": 7, "answer": False},
            )
        )
    )
    assert got == {
        0: HI,
        1: [("user", "hi"), ("assistant", "")],
        2: [],
        3: HI,
        4: [("system", "s")],
        5: HI,
        6: HI,
        7: [("user", ""), ("assistant", "x")],
        8: None,
        9: None,
        10: None,
        11: None,
        12: [("system", "be kind"), *HI],
        13: HI,
        14: [("user", "1.5"), ("assistant", "True")],
        15: [("user", "7"), ("assistant", "False")],
    }


def test_repeated_key_last_wins(json_records):
    got = talks(
        normalize_conversations(
            json_records('{"user":"a","User":"b","assistant":"x","assistant":"y"}')
        )
    )
    assert got[0] == [("user", "b"), ("assistant", "y")]


def test_alias_priority_over_column_order(spark):
    rows = spark.createDataFrame(
        [(1, "i", " a ", "q", "p")], "seq bigint, Input string, OUTPUT string, Question string, persona string"
    )
    got = resolve_columns(rows).first()
    assert (got["user"], got["assistant"], got["system"]) == ("q", "a", "p")


def test_csv_without_pair_columns(spark):
    rows = spark.createDataFrame([(1, "q")], "seq bigint, user string")
    assert talks(normalize_conversations(rows)) == {1: None}


def test_default_system(conversations):
    data = conversations(HI, [*HI, ("system", "own")], [], None)
    assert talks(with_default_system(data, " be nice ")) == {
        0: [("system", "be nice"), *HI],
        1: [*HI, ("system", "own")],
        2: [("system", "be nice")],
        3: None,
    }
    assert talks(with_default_system(data, " "))[0] == [("system", ""), *HI]
    assert talks(with_default_system(data, ""))[0] == HI


def test_pairs_both_ways(conversations):
    data = conversations(
        HI,
        [("system", ""), *HI],
        [("user", "hi"), ("system", "s1"), ("assistant", "yo"), ("system", "s2")],
        [*HI, *HI],
        [("assistant", "yo"), ("user", "hi")],
        [],
        None,
    )
    assert by_seq(messages_to_pairs(data), "system", "user", "assistant") == {
        0: (None, "hi", "yo"),
        1: (None, "hi", "yo"),
        2: ("s1", "hi", "yo"),
    }
    assert set(talks(non_pairs(data))) == {3, 4, 5, 6}
    assert talks(pairs_to_messages(messages_to_pairs(data)))[2] == [("system", "s1"), *HI]


def test_sharegpt_round_trip(conversations):
    data = conversations([("system", "s"), *HI, *HI])
    assert talks(sharegpt_to_messages(messages_to_sharegpt(data))) == talks(data)


def test_normalizing_twice_changes_nothing(json_records):
    from pyspark.sql import functions as F

    once = normalize_conversations(json_records(chat((" User ", " hi "), ("assistant", "yo"))), "s")
    again = once.select("seq", F.to_json(F.struct("messages")).alias("raw"))
    assert talks(normalize_conversations(again, "s")) == talks(once)


def test_kinds_are_told_without_spelling_out_values(json_records):
    """No schema of a whole record, list or turn; of texts only ``true`` and ``false`` are looked up."""
    records = json_records(
        chat(("user", "true"), ("assistant", True)),
        chat(("user", {"a": False}), ("assistant", [True])),
        {"user": "false", "assistant": False},
        {"messages": {"role": "user"}, "user": "hi", "assistant": "yo"},
        {"messages": None, "conversations": {}, "user": "hi", "assistant": "yo"},
        {},
    )
    got = normalize_conversations(records)
    assert talks(got) == {
        0: [("user", "true"), ("assistant", "True")],
        1: [("user", '{"a":false}'), ("assistant", "[true]")],
        2: [("user", "false"), ("assistant", "False")],
        3: HI,
        4: HI,
        5: None,
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    schemas = plan.count("schemaofvariant(") + plan.count("schema_of_variant(")
    assert 0 < schemas == plan.count("in (true,false)")
