import sys

from pyspark.sql import functions as F

from chatprep.functions.text import WHITESPACE, clean, drop_whitespace, token_estimate


def test_whitespace_is_every_unicode_space():
    assert sorted(WHITESPACE) == [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]


def test_clean_strips_all_kinds(spark):
    texts = [None, "", " a b ", "\u3000x\u2028", "\x1c\x85y\u00a0\n", WHITESPACE, "a\u3000b"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(clean(F.col("t"))).collect()]
    assert got == [(t or "").strip() for t in texts]
    dense = [r[0] for r in rows.select(drop_whitespace(clean(F.col("t")))).collect()]
    assert dense == ["".join((t or "").split()) for t in texts]


def test_token_estimate(spark):
    texts = ["", "abc", "abcde", "日本語", "abcd日本", "a\U0001f600b", "x" * 9]
    want = [
        sum(c < "\x80" for c in t) // 4 + sum(c >= "\x80" for c in t) for t in texts
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(token_estimate(F.col("t"))).collect()] == want
