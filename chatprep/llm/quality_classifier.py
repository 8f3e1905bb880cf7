"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are column expressions.  Small trees grown on random parts of a
labelled sample give rules: the path to each node is a conjunction of threshold tests.
Lasso logistic regression over the rules keeps few of them, and the kept ones become one
Spark column expression, so scoring is a projection of the scan.

Training takes at most ``SAMPLE`` labelled rows, chosen by hash, and fits on the driver
(only their statistics travel).  Statistics never look at language, source or id.

Null and empty texts get a score like any other: shares and averages are over one character,
word and line at least, so ``word_length`` is 1, ``line_words`` ln 2 and all else 0.  Without
labels every score is 0.5.  A document with several labels counts once per label.  Repeated rows
get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import SYMBOLS, is_held_out, read_table, seeded_hash, split_words

SAMPLE = 8000
TREES = 24
DEPTH = 3
LASSO = 0.002
THRESHOLD = 0.3
SEED = 11

STATISTICS = ["words", "word_length", "symbols", "upper", "marks", "digits", "distinct_words", "stutter", "distinct_lines", "line_words"]


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds the columns ``STATISTICS`` (doubles) to a table with ``text``; the text goes."""
    df = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    df = df.withColumn("stat_words", split_words(F.col("text")))
    df = df.withColumn("stat_lines", F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")
    n = F.greatest(F.size("stat_words"), F.lit(1)).cast("double")
    lines = F.greatest(F.size("stat_lines"), F.lit(1)).cast("double")

    def only(kept: str) -> Column:
        return F.length(F.regexp_replace("text", f"[^{kept}]+", ""))

    repeated = F.size("stat_words") - F.size(
        F.filter("stat_words", lambda w, i: (i == 0) | (w != F.coalesce(F.get("stat_words", i - 1), F.lit(""))))
    )
    values = {
        "words": F.log1p(F.size("stat_words").cast("double")),
        "word_length": chars / n,
        "symbols": only(SYMBOLS) / chars,
        "upper": only(r"\p{Lu}") / chars,
        "marks": only(r"!?;:=~^@\\") / chars,
        "digits": only("0-9") / chars,
        "distinct_words": F.size(F.array_distinct("stat_words")) / n,
        "stutter": repeated / n,
        "distinct_lines": F.size(F.array_distinct("stat_lines")) / lines,
        "line_words": F.log1p(n / lines),
    }
    return df.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()}).drop("text", "stat_words", "stat_lines")


@dataclass(frozen=True)
class Test:
    statistic: int
    above: bool
    at: float


Rule = tuple[Test, ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, t.statistic] > t.at) == t.above for t in rule])


def _grow(x: np.ndarray, y: np.ndarray, rule: Rule, columns: np.ndarray, depth: int, out: set[Rule]) -> None:
    """Rules of a tree that splits by the largest drop of the Gini impurity."""
    if depth == 0 or len(y) < 20 or y.min() == y.max():
        return
    best = (1e-9, None, None)
    base = y.mean() * (1 - y.mean())
    for c in columns:
        for at in np.unique(np.quantile(x[:, c], np.linspace(0.02, 0.98, 25))):
            high = x[:, c] > at
            k = high.sum()
            if min(k, len(y) - k) < 5:
                continue
            p, q = y[high].mean(), y[~high].mean()
            drop = base - (k * p * (1 - p) + (len(y) - k) * q * (1 - q)) / len(y)
            if drop > best[0]:
                best = (drop, c, float(f"{at:.6g}"))
    _, c, at = best
    if c is None:
        return
    for above in (False, True):
        side = (x[:, c] > at) == above
        longer = rule + (Test(int(c), above, at),)
        out.add(longer)
        if side.any():
            _grow(x[side], y[side], longer, columns, depth - 1, out)


def extract_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    draw = np.random.default_rng(SEED)
    found: set[Rule] = set()
    for _ in range(trees):
        rows = draw.choice(len(y), max(len(y) // 2, min(len(y), 40)), replace=False)
        columns = draw.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False)
        _grow(x[rows], y[rows], (), columns, depth, found)
    kept, seen = [], set()
    for rule in sorted(found, key=lambda r: (len(r), [(t.statistic, t.at, t.above) for t in r])):
        held = _holds(rule, x)
        if 0.002 < held.mean() < 0.998 and (key := held.tobytes()) not in seen:
            seen |= {key, (~held).tobytes()}
            kept.append(rule)
    return kept


def lasso_logistic(z: np.ndarray, y: np.ndarray, strength: float = LASSO, rounds: int = 600) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps."""
    z1 = np.column_stack([np.ones(len(y)), z]).astype(np.float64)
    step = 4 * len(y) / max(np.linalg.norm(z1, 2) ** 2, 1e-9)
    w = ahead = np.zeros(z1.shape[1])
    momentum = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z1 @ ahead, -30, 30)))
        new = ahead - step * (z1.T @ (p - y)) / len(y)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * strength, 0)
        faster = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead, w, momentum = new + (momentum - 1) / faster * (new - w), new, faster
    return float(w[0]), w[1:]


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The probability of label 1 as a column expression over ``STATISTICS``."""

        def term(rule: Rule, weight: float) -> Column:
            tests = [F.col(STATISTICS[t.statistic]) > t.at if t.above else F.col(STATISTICS[t.statistic]) <= t.at for t in rule]
            return F.when(reduce(lambda a, b: a & b, tests), F.lit(weight)).otherwise(F.lit(0.0))

        total = reduce(lambda a, b: a + b, [term(*r) for r in self.rules], F.lit(self.intercept))
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> RuleEnsemble:
    if not len(y):
        return RuleEnsemble(0.0, [])
    if y.min() == y.max():
        return RuleEnsemble(3.0 if y[0] else -3.0, [])
    rules = extract_rules(x, y)
    if not rules:
        return RuleEnsemble(math.log(y.mean() / (1 - y.mean())), [])
    intercept, weights = lasso_logistic(np.column_stack([_holds(r, x) for r in rules]), y)
    return RuleEnsemble(intercept, [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> RuleEnsemble:
    """From (doc_id, text) and (doc_id, label 0 or 1) rows."""
    chosen = (
        labels.filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .withColumn("draw", seeded_hash(SEED, F.col("doc_id")))
        .orderBy("draw", "doc_id", "label")
        .limit(sample)
        .select("doc_id", "label")
    )
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # Of ids that stand on many rows not all rows are learnt from.
    drawn = joined.withColumn("draw", seeded_hash(SEED, F.col("doc_id"), F.xxhash64("text")))
    rows = with_statistics(drawn.orderBy("draw", "doc_id", "label").limit(sample).drop("draw"))
    data = sorted(tuple(r) for r in rows.select("doc_id", "label", *STATISTICS).collect())
    return fit(np.array([r[2:] for r in data], float), np.array([r[1] for r in data], float))


def score_quality(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id and score of every (doc_id, text) row."""
    return with_statistics(docs.select("doc_id", "text")).select("doc_id", model.score().alias("score"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label"))
    model = train(docs, labels.filter(~is_held_out(F.col("doc_id"), 5, 0)))
    scored = score_quality(docs, model)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
