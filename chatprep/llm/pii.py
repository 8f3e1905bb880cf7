"""Personal data by weak supervision.

Patterns find plain cases (``email``, ``ip``, ``card``, ``phone``).  A second, looser set of
patterns proposes candidates elsewhere in the text: spelt-out addresses, numbers grouped
like phone numbers or cards, and numbers grouped like identity numbers.  Labelers vote on
every plain and proposed span, for, against or not at all: the strict patterns, a
checksum, gazetteers of number prefixes and domain endings, cue words before the span, and
the characters around it.

Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is and how likely each pattern is personal data.  A logistic span classifier over
shape and votes is trained on those likelihoods and decides about the proposed spans; it
can tell spans apart on which the labelers agree or are silent.

The texts are read once.  Vote patterns and shapes have few values, so their counts, which
Spark adds up over all documents, have a fixed bound and train on the driver.

Null texts are empty.  Without spans nothing is trained.  Repeated rows get equal results;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import read_table, stage
from chatprep.llm.spans import SPAN, Taken, listed, of_kind

KINDS = ["email", "ip", "card", "phone", "identity"]
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Proposed spans, by kind.
SPELT = re.compile(r"[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\))\x20?[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?(?:\[dot\]|\(dot\))\x20?)[A-Za-z0-9-]{1,63}){1,5}")
LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3}[\x20.-][0-9]{3,4}(?![0-9])")
GROUPED_CARD = re.compile(r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9])")
IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
PROPOSERS = [("email", SPELT), ("card", GROUPED_CARD), ("phone", LOCAL_PHONE), ("identity", IDENTITY)]
# Fixed values of the gazetteers.
ENDINGS = frozenset("com org net edu gov info io de fr es uk us eu it nl ch at ca au jp br in".split())
CARD_PREFIXES = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
CUES = re.compile(r"(?i)\b(tel|phone|call|fax|mobile|mail|e-mail|email|contact|card|visa|mastercard|ssn|social security|ip|address)\b\W*$")
COUNTER_CUES = re.compile(r"(?i)\b(order|invoice|isbn|version|build|serial|token|id|no|nr)\b\W*$")
LABELERS = ["strict", "checksum", "gazetteer", "cue", "surroundings"]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _is_byte(digits: str) -> bool:
    """At most 255, however many zeros come first."""
    left = digits.lstrip("0")
    return len(left) <= 3 and int(left or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the strict patterns, by kind and then start."""
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(_is_byte(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def proposed_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Looser matches that touch no span of ``taken`` nor a proposal of a kind before."""
    found, used = [], list(taken)
    for kind, pattern in PROPOSERS:
        held = Taken(used)  # matches of one pattern never overlap each other
        mine = [m.span() for m in pattern.finditer(text) if not held.overlaps(*m.span())]
        found += [(kind, *span) for span in mine]
        used += mine
    return found


def votes(text: str, kind: str, start: int, end: int, strict: bool) -> list[int]:
    """One vote of each labeler: 1 for, -1 against, 0 none."""
    span, digits = text[start:end], _digits(text[start:end])
    before = text[max(0, start - 24) : start]
    check = 0
    if kind == "card":
        check = 1 if luhn(digits) else -1
    elif kind == "ip":
        check = 1 if all(len(p) == 1 or p[0] != "0" for p in span.split(".")) else -1
    elif kind == "identity":
        check = -1 if digits[:3] in ("000", "666") or digits[0] == "9" or digits[3:5] == "00" or digits[5:] == "0000" else 0
    known = 0
    if kind == "email":
        known = 1 if re.split(r"[^A-Za-z0-9]+", span)[-1].lower() in ENDINGS else -1
    elif kind == "card":
        known = 1 if digits.startswith(CARD_PREFIXES) else -1
    elif kind == "phone":
        known = 1 if span[0] == "+" and digits[0] != "0" else 0
    cue = 1 if CUES.search(before) else -1 if COUNTER_CUES.search(before) else 0
    around = before[-1:] + text[end : end + 1]
    joined = any(c.isalnum() or c in "_=/" for c in around)
    return [1 if strict else 0, check, known, cue, -1 if joined else 1]


def shape(kind: str, span: str) -> list[int]:
    """Kind, digits in bins of four, and separators: a few hundred values at most."""
    return [KINDS.index(kind), min(len(_digits(span)) // 4, 5), min(sum(not c.isalnum() for c in span), 5)]


CANDIDATE = "struct<kind:string,start:int,end:int,votes:array<int>,shape:array<int>>"
SCAN = f"doc_id bigint, base array<{SPAN}>, seen array<struct<votes:array<int>,shape:array<int>>>, others array<{CANDIDATE}>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ints = pa.list_(pa.int32())
    span = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
    judged = [("votes", ints), ("shape", ints)]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("base", pa.list_(pa.struct(span))), ("seen", pa.list_(pa.struct(judged))), ("others", pa.list_(pa.struct(span + judged)))]
    )
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            columns: tuple[list, list, list] = ([], [], [])
            for text in batch.column(1).slice(at, 512):
                text = text.as_py() or ""
                plain = base_spans(text)
                more = proposed_spans(text, [s[1:] for s in plain])
                columns[0].append([{"kind": k, "start": s, "end": e} for k, s, e in plain])
                columns[1].append([{"votes": votes(text, k, s, e, True), "shape": shape(k, text[s:e])} for k, s, e in plain])
                columns[2].append(
                    [{"kind": k, "start": s, "end": e, "votes": votes(text, k, s, e, False), "shape": shape(k, text[s:e])} for k, s, e in more]
                )
            ids = batch.column(0).slice(at, 512)
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema)


def reliabilities(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Likelihood that each vote pattern (rows of -1, 0, 1) is personal data, by EM.

    A labeler has its own chance of each vote given the truth; the first guess is that
    votes are right four times out of five.
    """
    index = patterns + 1
    table = np.tile(np.array([[0.4, 0.4, 0.1], [0.1, 0.4, 0.4]]), (patterns.shape[1], 1, 1)) + 0.05  # labeler, truth, vote
    table /= table.sum(axis=2, keepdims=True)
    prior = 0.5
    for _ in range(rounds):
        score = np.log(prior / (1 - prior)) + sum(
            np.log(table[k, 1, index[:, k]]) - np.log(table[k, 0, index[:, k]]) for k in range(patterns.shape[1])
        )
        true = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        for k in range(patterns.shape[1]):
            for truth, weight in ((0, counts * (1 - true)), (1, counts * true)):
                seen = np.bincount(index[:, k], weight, 3) + np.array([[1.0, 2.0, 0.5], [0.5, 2.0, 1.0]])[truth]
                table[k, truth] = seen / seen.sum()
        prior = float(np.clip((counts * true).sum() / counts.sum(), 0.02, 0.98))
    return true


def _features(patterns: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """Votes except that of the strict patterns, and the shape, one column per value."""
    votes_for = [(patterns[:, k] == v) for k in range(1, patterns.shape[1]) for v in (-1, 1)]
    shape_is = [(shapes[:, k] == v) for k in range(shapes.shape[1]) for v in range(6)]
    return np.column_stack([np.ones(len(patterns)), *votes_for, *shape_is]).astype(float)


def train_spans(patterns: np.ndarray, shapes: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights of the span classifier: logistic regression on the likelihoods that EM gives."""
    truth = reliabilities(patterns, counts)
    x = _features(patterns, shapes)
    w = np.zeros(x.shape[1])
    for _ in range(50):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (counts * (p - truth)) + ridge * w
        curve = (x * (counts * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def find_personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, base (strict spans) and spans (with accepted proposals), by kind and start."""
    scanned = stage(docs.select("doc_id", "text").mapInArrow(_scan, SCAN), "pii-scan")
    every = F.concat("seen", F.transform("others", lambda o: F.struct(o["votes"].alias("votes"), o["shape"].alias("shape"))))
    counts = scanned.select(F.explode(every).alias("x")).groupBy("x.votes", "x.shape").agg(F.count(F.lit(1)).alias("n"))
    rows = sorted(counts.collect(), key=lambda r: (r["votes"], r["shape"]))  # at most a few thousand patterns
    weights = None
    if rows:
        weights = train_spans(*(np.array([r[c] for r in rows]) for c in ("votes", "shape")), np.array([float(r["n"]) for r in rows]))

    @F.pandas_udf(f"array<{SPAN}>")
    def accepted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            out = []
            for others in column:
                if not len(others):
                    out.append([])
                    continue
                x = _features(np.array([list(o["votes"]) for o in others]), np.array([list(o["shape"]) for o in others]))
                good = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))) >= least
                out.append([{"kind": o["kind"], "start": o["start"], "end": o["end"]} for o, g in zip(others, good) if g])
            yield pd.Series(out)

    none = F.array().cast(f"array<{SPAN}>")
    order = F.array(*[F.lit(k) for k in KINDS])

    def in_order(spans):
        ranked = F.transform(spans, lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    judged = scanned.withColumn("added", accepted(F.col("others")) if rows else none)
    return judged.select("doc_id", in_order(F.col("base")).alias("base"), in_order(F.concat("base", "added")).alias("spans"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[of_kind(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:4]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
