import csv
import json
import random
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from chatprep.operators.normalize import normalize_conversations, resolve_columns
from chatprep.plans.jobs import (
    build_dataset,
    prepare_from_csv_or_jsonl,
    render_training_text,
    validate_dataset,
)
from chatprep.plans.queries import QUERIES
from chatprep.sinks.documents import write_documents
from chatprep.sinks.writers import write_merged_csv
from chatprep.sources.files import (
    read_csv_records,
    read_json_records,
    read_pairs,
    read_records,
    read_training_json,
)
from chatprep.sources.quoted import INSIDE, OUTSIDE, _after
from chatprep.operators.render import learned_total, render_chat_text, response_mask_report
from chatprep.staging import staging_folder
from chatprep.sources.turns import chat_turns_to_conversations
from conftest import talks

HI = [("user", "hi"), ("assistant", "yo")]
PAIR = '{"user":"hi","assistant":"yo"}'


def put(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.parent.mkdir(exist_ok=True)
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def test_csv(spark, tmp_path):
    path = put(
        tmp_path,
        "a.csv",
        'Question,x,Answer\r\n"a\nb","1","say ""hi"", ok"\r\n\r\nshort\r\n1,2,3,4\r\n',
        "utf-8-sig",
    )
    rows = read_csv_records(spark, path).orderBy("seq").collect()
    assert [tuple(r)[2:] for r in rows] == [
        ("a\nb", "1", 'say "hi", ok'),
        ("short", None, None),
        ("1", "2", "3"),
    ]
    pairs = read_pairs(spark, path).orderBy("seq").collect()
    assert [tuple(r)[1:] for r in pairs] == [("a\nb", 'say "hi", ok'), ("1", "3")]


def test_csv_repeated_name_last_wins(spark, tmp_path):
    path = put(tmp_path, "a.csv", "user,User,assistant,seq\n1,2,3,4\n")
    got = resolve_columns(read_csv_records(spark, path)).first()
    assert (got["user"], got["assistant"]) == ("2", "3")


def test_csv_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        read_csv_records(spark, put(tmp_path, "empty.csv", ""))
    with pytest.raises(ValueError, match="user/assistant"):
        read_pairs(spark, put(tmp_path, "b.csv", "user,text\n1,2\n"))
    with pytest.raises(ValueError, match="file type"):
        read_records(spark, "a.txt")
    with pytest.raises(PySparkException):
        read_records(spark, str(tmp_path / "missing.csv"))


@pytest.mark.parametrize(
    "text, want",
    [
        ("", []),
        ("\n \n", []),
        (PAIR, [HI]),
        (f"{PAIR}\n\n  {PAIR}\n[1,2]\n5", [HI, HI, None, None]),
        (f"[{PAIR}, 5, \"{{}}\", {PAIR}]", [HI, None, None, HI]),
        ('{\n "user": "hi",\n "assistant": "yo"\n}\n', [HI]),
        (f"[\n{PAIR},\n{PAIR}\n]", [HI, HI]),
        ("5", [None]),
    ],
)
def test_json_layouts(spark, tmp_path, text, want):
    path = put(tmp_path, "a.json", text)
    got = talks(normalize_conversations(read_records(spark, path)))
    assert [got[k] for k in sorted(got)] == want


@pytest.mark.parametrize("bad", ["{broken", f"{PAIR} junk", f"{PAIR}}}", f"{PAIR}]", f"{PAIR},{PAIR}"])
def test_bad_line_is_named(spark, tmp_path, bad):
    path = put(tmp_path, "a.jsonl", f"{PAIR}\n{PAIR}\n{bad}\n{PAIR}\n")
    with pytest.raises(PySparkException, match="Line 3"):
        read_json_records(spark, path).collect()


def test_bad_document(spark, tmp_path):
    with pytest.raises(PySparkException, match="not valid JSON"):
        read_json_records(spark, put(tmp_path, "a.json", '{"user":\n "hi"')).collect()


def test_line_separators_inside_values(spark, tmp_path):
    text = "a\u2028b\u2029c\x85d"
    path = put(tmp_path, "a.jsonl", json.dumps({"user": text, "assistant": "y"}, ensure_ascii=False) + "\n" + PAIR)
    got = talks(read_training_json(spark, path))
    assert [got[k][0][1] for k in sorted(got)] == [text, "hi"]


def test_order_over_files_and_splits(spark, tmp_path):
    """seq follows path order, then place in the file, however the scan is cut."""
    rows = []
    for name, n in [("b.jsonl", 9000), ("a.jsonl", 20), ("c.jsonl", 700)]:
        body = [f"{name}-{i}" for i in range(n)]
        put(tmp_path / "in", name, "".join(
            json.dumps({"user": u, "assistant": "y" * 300}) + "\n" for u in body
        ))
        rows.append((name, body))
    want = [u for _, body in sorted(rows) for u in body]
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (default, "1m", "20000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            records = read_json_records(spark, str(tmp_path / "in"), layout="lines")
            got = normalize_conversations(records).orderBy("seq").collect()
            assert [r["messages"][0]["content"] for r in got] == want
            assert len({r["seq"] for r in got}) == len(want)
        assert records.rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def test_large_unsplittable_file_is_spread(spark, tmp_path):
    body = "user,assistant\n" + "".join(f'q{i},"{"y" * 300}\n"\n' for i in range(9000))
    document = "[" + ",\n".join(json.dumps({"user": f"q{i}", "assistant": "y" * 300}) for i in range(9000)) + "]"
    paths = [put(tmp_path, "a.csv", body), put(tmp_path, "a.json", document)]
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
        for path in paths:
            records = read_records(spark, path)
            assert records.rdd.getNumPartitions() > 1
            got = normalize_conversations(records).orderBy("seq").collect()
            assert [r["messages"][0]["content"] for r in got] == [f"q{i}" for i in range(9000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)


def lines(folder):
    texts = [p.read_text(encoding="utf-8") for p in sorted(folder.glob("part-*"))]
    return [json.loads(x) for t in texts for x in t.split("\n") if x]


def test_build_writes_three_sets(spark, tmp_path):
    body = "user,assistant\n" + "".join(f"q{i},回答{i}\n" for i in range(25)) + "q1,回答1\nx,\n"
    out = tmp_path / "out"
    built = build_dataset(spark, put(tmp_path, "a.csv", body), str(out), system="be kind")
    report = built.report.first().asDict()
    assert (report["count"], report["input_rows"], report["skipped"], report["duplicates"]) == (25, 27, 1, 1)
    assert [r["reason"] for r in built.rejects.collect()] == ["empty assistant message / assistant の中身が空です"]
    sharegpt = lines(out / "train_sharegpt.jsonl")
    assert [r["conversations"][1]["value"] for r in sharegpt] == [f"q{i}" for i in range(25)]
    assert sharegpt[0] == {"conversations": [
        {"from": "system", "value": "be kind"},
        {"from": "human", "value": "q0"},
        {"from": "gpt", "value": "回答0"},
    ]}
    assert "回答0" in next((out / "train_sharegpt.jsonl").glob("part-*")).read_text(encoding="utf-8")
    train, valid = lines(out / "train.jsonl"), lines(out / "valid.jsonl")
    asked = [[r["messages"][1]["content"] for r in side] for side in (train, valid)]
    assert len(valid) == 2 and sorted(asked[0] + asked[1]) == sorted(f"q{i}" for i in range(25))
    checked = validate_dataset(spark, str(out / "train_sharegpt.jsonl"))
    assert checked.report.first()["passed"]
    assert sorted(map(str, talks(checked.kept).values())) == sorted(map(str, talks(built.kept).values()))
    text, mask = render_training_text(spark, str(out / "valid.jsonl"))
    assert text.count() == 2 and mask.filter("has_response").count() == 2


def test_build_with_merging(spark, tmp_path):
    path = put(tmp_path, "a.csv", "user,assistant\nq,A\nq,B\nr,C\nr,C\n")
    built = build_dataset(spark, path, str(tmp_path / "out"), merge_same_user=True)
    assert tuple(built.merge.first()) == (1, 2, 2)
    assert built.report.first()["input_rows"] == 2


def test_nothing_kept_writes_nothing(spark, tmp_path):
    path = put(tmp_path, "a.csv", "user,assistant\n,A\n")
    built = build_dataset(spark, path, str(tmp_path / "out"))
    assert built.report.first()["level"] == "error" and not (tmp_path / "out").exists()
    report = validate_dataset(spark, path).report.first()
    assert not report["passed"] and report["skipped"] == 1


def test_prepare(spark, tmp_path):
    ready = put(tmp_path, "a.jsonl", PAIR)
    assert prepare_from_csv_or_jsonl(spark, ready) == ready
    repeated = put(tmp_path, "b.csv", 'prompt,completion\nq,A\nq,"B, ""b"""\nr,\n')
    target = prepare_from_csv_or_jsonl(spark, repeated, str(tmp_path / "out"))
    got = talks(read_training_json(spark, target))
    assert [m for m in got.values()] == [
        [("user", "q"), ("assistant", '候補は複数あります。代表的な回答は次のとおりです。\n1. A\n2. B, "b"')]
    ]
    single = put(tmp_path, "c.csv", "user,assistant\nq,A\n")
    prepare_from_csv_or_jsonl(spark, single, str(tmp_path / "out2"))
    assert not (tmp_path / "out2" / "merged.csv").exists()


def test_merged_csv_reads_back(spark, tmp_path, pairs):
    rows = pairs(("s", 'a "q"', "x\ny"), (None, "b,c", ""))
    path = str(tmp_path / "m.csv")
    write_merged_csv(rows, path)
    got = resolve_columns(read_csv_records(spark, path)).orderBy("seq").collect()
    assert [tuple(r)[1:] for r in got] == [('a "q"', "x\ny", "s"), ("b,c", "", "")]


def test_turn_table(spark):
    turns = spark.createDataFrame(
        [(1, 1, "Assistant", " yo "), (2, 0, "user", "x" * 200), (1, 0, "user", None), (2, 1, "user", "z")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    got = talks(chat_turns_to_conversations(turns))
    assert got == {
        1: [("user", ""), ("assistant", "yo")],
        2: [("user", "x" * 200), ("user", "z")],
    }


def test_order_is_unique_however_files_are_cut(spark, tmp_path):
    body = "".join(f'{{"user":"q{i}","assistant":"{"a" * 80}"}}\n' for i in range(8000))
    for name in ("a.jsonl", "b.jsonl"):
        put(tmp_path, name, body)
    for option, value in (("openCostInBytes", "65536"), ("maxPartitionBytes", "100000")):
        spark.conf.set(f"spark.sql.files.{option}", value)
    try:
        rows = read_json_records(spark, str(tmp_path)).select("seq", "raw").orderBy("seq").collect()
    finally:
        for option in ("openCostInBytes", "maxPartitionBytes"):
            spark.conf.unset(f"spark.sql.files.{option}")
    assert len({r["seq"] for r in rows}) == 16000
    asked = [r["raw"].split('"')[3] for r in rows]
    assert asked == [f"q{i}" for i in range(8000)] * 2


def test_folder_with_two_headers_fails(spark, tmp_path):
    put(tmp_path, "a.csv", "user,assistant\nq1,a1\n")
    put(tmp_path, "b.csv", "assistant,user\na2,q2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_records(spark, str(tmp_path)).collect()


def test_csv_with_a_raw_column_only_is_no_json(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'raw\n"{""user"":""q"",""assistant"":""A""}"\n')
    built = build_dataset(spark, path, str(tmp_path / "out"))
    assert tuple(r["reason"] for r in built.rejects.collect()) == ("no user/assistant pair found",) or built.rejects.count() == 1
    assert built.kept.count() == 0


def test_bad_first_line_is_named(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"user": oops\n{"user":"q","assistant":"A"}\n')
    with pytest.raises(Exception, match="Line 1 of"):
        read_json_records(spark, path).collect()


def test_pretty_printed_document(spark, tmp_path):
    path = put(tmp_path, "a.json", '[\n  {\n "user": "q",\n "assistant": "A"\n },\n {"user": "r", "assistant": "B"}\n]\n')
    got = talks(read_training_json(spark, path))
    assert [m[0] for m in got.values()] == [("user", "q"), ("user", "r")]


def test_nothing_learned(spark, conversations):
    data = conversations([("user", "q")], None, [("user", "q"), ("assistant", "abcd")])
    report = response_mask_report(data)
    assert {r["seq"]: (r["learned_chars"], r["has_response"]) for r in report.collect()} == {0: (0, False), 1: (0, False), 2: (4, True)}
    assert tuple(learned_total(report).first()) == (3, 1, 1, True)
    assert not learned_total(report.filter("seq < 2")).first()["passed"]
    assert render_chat_text(data).count() == 2


# Files in many splits.


@pytest.fixture
def small_splits(spark):
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield use
    spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted_rows(n):
    draw = random.Random(n)
    cells = ["plain", "", 'say "hi"', "a,b", "line\nbreak", "two\r\nbreaks\n\n", '"', '"",\n"', "x" * 90, "\n" * 40, "ende\u00e9\U0001f600"]
    return [(f"q{i} {draw.choice(cells)}", draw.choice(cells), draw.choice(cells)) for i in range(n)]


def as_csv(rows, end):
    quoted = lambda c: '"' + c.replace('"', '""') + '"' if any(x in c for x in '",\n\r') or len(c) % 3 == 0 and c else c
    return "".join(",".join(map(quoted, r)) + end for r in rows)


@pytest.mark.parametrize("end, size", [("\n", "250"), ("\r\n", "900"), ("\r\n", "64m")])
def test_quoted_csv_in_many_splits(spark, tmp_path, small_splits, end, size):
    """Line breaks, quotes and empty lines in cells, wherever the file is cut."""
    rows = quoted_rows(150)
    rows[120] = ("long", "a\n" * 700, "b")  # one cell over many splits
    text = "user,assistant,note" + end + as_csv(rows[:100], end) + end + as_csv(rows[100:], end)
    path = put(tmp_path, "a.csv", "\ufeff" + text)
    small_splits(size)
    got = [tuple(r)[2:] for r in read_csv_records(spark, path).orderBy("seq").collect()]
    assert got == [tuple(c if c else None if '""' not in as_csv([(c,)], "") else "" for c in r) for r in rows]


def test_quoted_csv_is_read_by_many_tasks_without_moving_text(spark, tmp_path, small_splits):
    path = put(tmp_path, "a.csv", "user,assistant\n" + as_csv([r[:2] for r in quoted_rows(1000)], "\n"))
    small_splits("4000")
    df = read_csv_records(spark, path)
    assert df.select(F.spark_partition_id()).distinct().count() > 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    whole = plan.split("Union")[1].split("Filter (kind")[0] if "Filter (kind" in plan else plan
    assert "Exchange hashpartitioning" not in whole.split("MapInArrow")[0]


def test_quoted_csv_over_files(spark, tmp_path, small_splits):
    small_splits("300")
    rows = quoted_rows(60)
    for k, name in enumerate("abc"):
        put(tmp_path / "in", f"{name}.csv", "user,assistant,note\n" + as_csv(rows[20 * k : 20 * k + 20], "\n"))
    got = [r["user"] for r in read_csv_records(spark, str(tmp_path / "in")).orderBy("seq").collect()]
    assert got == [r[0] for r in rows]
    put(tmp_path / "in", "d.csv", "user,assistant,other\n1,2,3\n")
    with pytest.raises(PySparkException, match="header"):
        read_csv_records(spark, str(tmp_path / "in")).collect()


def test_csv_of_lone_returns_and_open_quotes(spark, tmp_path):
    path = put(tmp_path, "a.csv", "user,assistant\r1,2\r3,4\r")
    assert [tuple(r)[2:] for r in read_csv_records(spark, path).orderBy("seq").collect()] == [("1", "2"), ("3", "4")]
    path = put(tmp_path, "b.csv", 'user,assistant\nin "the" middle,x"y\n"closed" then,"",\n')
    assert [tuple(r)[2:] for r in read_csv_records(spark, path).orderBy("seq").collect()][0] == ('in "the" middle', 'x"y')


@pytest.mark.parametrize("seed", range(3))
def test_state_of_lines_against_a_csv_parser(seed):
    draw = random.Random(seed)
    for _ in range(3000):
        line = "".join(draw.choices('a",', k=draw.randrange(0, 9)))
        rows = list(csv.reader([line + "\n", "END\n"]))
        # If the cell is open, the next line is part of the same record.
        assert (_after(line, OUTSIDE) == INSIDE) == (len(rows) == 1), line


def list_text(records, draw):
    """A JSON list with white space of all kinds between its elements."""
    space = lambda: draw.choice(["", "", " ", "\n", "\r\n\t "])
    return space() + "[" + ",".join(space() + json.dumps(r, ensure_ascii=draw.random() < 0.5) + space() for r in records) + "]" + space()


@pytest.mark.parametrize("size, seed", [("150", 1), ("800", 2), ("64m", 1)])
def test_json_list_in_many_splits(spark, tmp_path, small_splits, size, seed):
    draw = random.Random(seed)
    texts = ["a", 'say "x"', "}", "{", "}, {", "[1, 2", "\\", '\\"', "\n", "é\U0001f600", "],[", "", "x" * 200]
    records = [draw.choice([{"user": draw.choice(texts), "assistant": draw.choice(texts), "n": [i, {"k": [draw.choice(texts)]}]}, [i, {}], i, "s}" + draw.choice(texts), None]) for i in range(90)]
    records[70] = {"user": "u", "assistant": 'long }"{[' * 100}
    path = put(tmp_path, "a.json", list_text(records, draw))
    small_splits(size)
    rows = read_json_records(spark, path).orderBy("seq").collect()
    assert len({r["seq"] for r in rows}) == len(rows)
    assert [json.loads(r["raw"]) if r["raw"] is not None else None for r in rows] == [r if isinstance(r, dict) else None for r in records]


def test_json_list_is_read_by_many_tasks(spark, tmp_path, small_splits):
    records = [{"user": f"u{i}", "assistant": "y" * 300} for i in range(2000)]
    path = put(tmp_path, "a.json", json.dumps(records))  # one line
    small_splits("20000")
    df = read_json_records(spark, path)
    assert df.select(F.spark_partition_id()).distinct().count() > 20
    assert [json.loads(r["raw"])["user"] for r in df.orderBy("seq").collect()] == [r["user"] for r in records]


@pytest.mark.parametrize(
    "bad", ["[", "[1,]", "[,1]", "[1,,2]", '[{"a":1]', '[{"a":1}', '[{"a":1}]]', "[1] 2", '[{"a":"}]', '["a]', "[1}", '[{"a":1}}', '[{"a" 1}]']
)
def test_bad_lists(spark, tmp_path, small_splits, bad):
    small_splits("3" if len(bad) % 2 else "64m")
    with pytest.raises(PySparkException, match="not valid JSON"):
        read_json_records(spark, put(tmp_path, "a.json", bad), layout="document").collect()


@pytest.mark.parametrize("text, rows", [("[]", 0), (" [ \n ] ", 0), ("[[]]", 1), ("[{}]", 1), ('["]"]', 1)])
def test_small_lists(spark, tmp_path, text, rows):
    assert len(read_json_records(spark, put(tmp_path, "a.json", text), layout="document").collect()) == rows


def test_line_number_over_splits_and_files(spark, tmp_path, small_splits):
    good = [json.dumps({"user": f"u{i}", "assistant": "y" * 100}) for i in range(2000)]
    for name in ("a", "c"):
        put(tmp_path / "in", f"{name}.jsonl", "\n".join(good[:50]) + "\n")
    put(tmp_path / "in", "b.jsonl", "\n".join([*good[:700], "", "{broken", *good[700:]]) + "\n")
    for size in ("40000", "64m"):  # splits of one file, and files that share a task
        small_splits(size)
        for job in (lambda: build_dataset(spark, str(tmp_path / "in") + "/*.jsonl", str(tmp_path / "out"), layout="lines"), lambda: validate_dataset(spark, str(tmp_path / "in") + "/*.jsonl", layout="lines")):
            with pytest.raises(ValueError, match="Line 702 of .*b.jsonl"):
                job()


@pytest.mark.parametrize("ending", ["json", "dat"])
@pytest.mark.parametrize("kind", ["objects", "lists", "mixed", "large"])
def test_many_small_documents_share_tasks(spark, tmp_path, small_splits, ending, kind):
    want = []
    for i in range(400):
        record = {"user": f"u{i}", "assistant": "y" * (1_500_000 if kind == "large" and i == 7 else 50)}
        listed = kind == "lists" or (kind == "mixed" and i % 2 == 0)
        records = [record, {**record, "assistant": "}"}] if listed else [record]
        put(tmp_path / "in", f"{i:03}.{ending}", " \ufeff"[:1 + (i % 2 and listed)] + json.dumps(records if listed else record, indent=1) + "\n")
        want += records
    put(tmp_path / "in", f"empty.{ending}", "")
    small_splits("1m")
    spark.conf.unset("spark.sql.files.openCostInBytes")  # 4 MB
    df = read_json_records(spark, str(tmp_path / "in"), layout="document")
    assert df.rdd.getNumPartitions() < 100
    rows = df.orderBy("seq").collect()
    assert len({r["seq"] for r in rows}) == len(rows)
    assert [json.loads(r["raw"]) for r in rows] == want


def test_many_small_documents_with_a_fault(spark, tmp_path):
    for i in range(300):
        put(tmp_path / "in", f"{i}.json", PAIR if i != 150 else PAIR[:-1])
    with pytest.raises(PySparkException, match="150.json is not valid JSON"):
        read_json_records(spark, str(tmp_path / "in"), layout="document").collect()


def test_write_documents(spark, tmp_path):
    texts = ["a", 'b\n"b"', "é\U0001f600", "", None, "a"]
    path = tmp_path / "out.json"
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(3)
    write_documents(df, str(path))
    files = [f for f in path.rglob("*") if f.is_file()]
    assert sorted(f.read_text(encoding="utf-8") for f in files) == sorted((t or "") + "\n" for t in texts)
    assert len(list(path.iterdir())) <= 3 and all(f.parent.name.startswith("part=") for f in files)
    assert spark.read.text(str(path), wholetext=True).count() == len(texts)
    with pytest.raises(FileExistsError):
        write_documents(df, str(path))
    write_documents(df.limit(0), str(tmp_path / "none.json"))
    assert read_json_records(spark, str(tmp_path / "none.json"), layout="document").collect() == []


def test_one_file_per_conversation_in_few_folders(spark, tmp_path):
    talk = [(i * 7, turn, role, f"{role} {i}") for i in range(40) for turn, role in enumerate(["user", "assistant"])]
    spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    staging = Path(staging_folder(spark))
    before = set(staging.glob("objects-*.json"))
    got = QUERIES["json_object_file"](spark, str(tmp_path)).collect()
    (written,) = set(staging.glob("objects-*.json")) - before
    assert sorted(r["dialog"] for r in got) == sorted(f"user: user {i}\nassistant: assistant {i}" for i in range(40))
    files = [f for f in written.glob("*/*") if f.name[0] not in "._"]
    assert sorted(json.loads(f.read_text())["conversations"][0]["value"] for f in files) == sorted(f"user {i}" for i in range(40))
    assert all(f.read_text().count("\n") > 2 for f in files)
    assert len({f.parent for f in files}) <= 4  # a folder per task, not per conversation
