"""Quality rules with cross-document line frequency.

Per document: counts of words, symbols, repeated lines and repeated 5-word windows, and
the base rules on them.  Across documents: lines are normalised (ASCII lower case, digits
to 0, runs of white space to one blank) and hashed; the documents that hold a line are
counted per host.  A line above the limit of its host is removed, and a document that
keeps too few words after that is rejected.

The limit is ``LINE_SHARE`` of the host's documents, at least ``LINE_DOCS`` and at most
``LINE_MOST`` of them, however large the host.  Every row is a document, so the lines of a
page that is repeated word for word count as often as the page.

Everything is a column expression; the text is read once and only hashes travel.  Rows of
one host and text are folded with their number before any line is exploded, and counts are
summed on the map side, so one line, text or host with a third of all rows is a few partial
sums.

Null and empty texts have no words and fail the base rules.  Null hosts are one host.
Repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import SPACE, SYMBOLS, UPPER, fresh, group_key, read_table, split_words, stage

SHINGLE = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
LINE_SHARE = 0.02
LINE_DOCS = 20
LINE_MOST = 1000
KEPT_PERCENT = 30
DIGITS = "0123456789"


def normal_line(line: Column) -> Column:
    folded = F.translate(line, UPPER + DIGITS, UPPER.lower() + "0" * 10)
    return F.trim(F.regexp_replace(folded, SPACE, " "))


def with_repeats(df: DataFrame, words: str, out: str, n: int = SHINGLE) -> DataFrame:
    """Adds ``out``: how many words stand in n-word windows that the array holds twice or more.

    Windows are hashed per row.  Only rows with a repeated hash sort (hash, position) pairs;
    equal neighbours are the repeated windows, and their positions in order give the words
    they cover.  Each step is a column of its own, computed once per row.
    """
    hashes, order, starts = (fresh(df, f"{out}_{k}") for k in ("hashes", "order", "starts"))
    gram = F.transform(
        F.sequence(F.lit(0), F.size(words) - n),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]),
    )
    df = df.withColumn(hashes, F.when(F.size(words) >= n, gram).otherwise(F.array().cast("array<bigint>")))
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(order, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs))

    def twin(x, j):
        before, after = F.get(order, j - 1)["h"], F.get(order, j + 1)["h"]
        return F.when((before == x["h"]) | (after == x["h"]), x["i"])

    df = df.withColumn(starts, F.sort_array(F.filter(F.transform(order, twin), lambda p: p.isNotNull())))
    gaps = F.transform(starts, lambda p, j: F.least(F.coalesce(F.get(starts, j + 1) - p, F.lit(n)), F.lit(n)))
    total = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("bigint"))).drop(hashes, order, starts)


def document_counts(docs: DataFrame) -> DataFrame:
    """One stored row per document: ids, base counts and the hashes of its distinct lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", group_key(F.col("source")).alias("host"), F.xxhash64("text").alias("digest"), text.alias("text"))
    df = df.withColumn("w", split_words(F.col("text")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")))
    df = df.select(
        "doc_id",
        "host",
        "digest",
        "w",
        F.size("w").cast("bigint").alias("n_words"),
        F.aggregate("w", F.lit(0).cast("bigint"), lambda a, s: a + F.length(s)).alias("word_chars"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(
            "lines", lambda s: F.struct(F.xxhash64(normal_line(s)).alias("line"), F.size(split_words(s)).alias("words"))
        ).alias("lines"),
    )
    df = with_repeats(df, "w", "n_repeat_words").drop("w")
    return stage(df, "document-counts")


def frequent_lines(texts: DataFrame, share: float = LINE_SHARE, least: int = LINE_DOCS, most: int = LINE_MOST) -> DataFrame:
    """(host, line) above the limit of the host; ``texts`` has a row per host and text, held by ``docs`` documents."""
    hosts = texts.groupBy("host").agg(F.sum("docs").alias("of_host"))
    held = texts.select("host", "docs", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    counts = held.groupBy("host", "line").agg(F.sum("docs").alias("n")).filter(F.col("n") > least)
    limit = F.least(share * F.col("of_host"), F.lit(float(most)))
    return counts.join(hosts, "host").filter(F.col("n") > limit).select("host", "line")


def depletion(counted: DataFrame) -> DataFrame:
    """(host, digest, removed): words in removed lines, for texts that lose any."""
    texts = counted.groupBy("host", "digest").agg(F.first("lines").alias("lines"), F.count(F.lit(1)).alias("docs"))
    texts = stage(texts, "distinct-texts")
    lines = texts.select("host", "digest", F.explode("lines").alias("x")).select("host", "digest", "x.line", "x.words")
    return (
        lines.join(frequent_lines(texts), ["host", "line"], "left_semi")
        .groupBy("host", "digest")
        .agg(F.sum("words").cast("bigint").alias("removed"))
    )


def judge(docs: DataFrame, kept_percent: int = KEPT_PERCENT) -> DataFrame:
    """doc_id, the base counts, base_failed, removed_words and kept of every document."""
    counted = document_counts(docs)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    removed = F.coalesce("removed", F.lit(0)).cast("bigint")
    left = F.col("n_words") - removed
    enough = (removed == 0) | ((left >= MIN_WORDS) & (100 * left >= kept_percent * F.col("n_words")))
    return counted.drop("lines").join(depletion(counted), ["host", "digest"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        removed.alias("removed_words"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text,
    CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS host,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT rn, host, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words,
    trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', 'abcdefghijklmnopqrstuvwxyz0000000000'),
      '[\x20\x09-\x0D]+', ' ', 'g')) AS normal
  FROM (SELECT rn, host, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dup AS (
  SELECT rn, count(*) - count(DISTINCT line) AS n_dup_lines FROM l GROUP BY rn
), hosts AS (
  SELECT host, count(*) AS docs FROM d GROUP BY host
), frequent AS (
  SELECT host, normal FROM (SELECT host, normal, count(DISTINCT rn) AS n FROM l GROUP BY host, normal) JOIN hosts USING (host)
  WHERE n > 20 AND n > least(0.02 * docs, 1000)
), lost AS (
  SELECT rn, sum(words) AS removed FROM l JOIN frequent USING (host, normal) GROUP BY rn
), grams AS (
  SELECT rn, st, array_to_string(w[st:st + 4], ' ') AS g FROM (SELECT rn, w, unnest(range(1, len(w) - 3)) AS st FROM d WHERE len(w) >= 5)
), twins AS (
  SELECT rn, st FROM (SELECT rn, st, count(*) OVER (PARTITION BY rn, g) AS n FROM grams) WHERE n > 1
), repeats AS (
  SELECT rn, count(DISTINCT p) AS n_repeat_words FROM (SELECT rn, unnest(range(st, st + 5)) AS p FROM twins) GROUP BY rn
), counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS removed_words
  FROM d LEFT JOIN dup USING (rn) LEFT JOIN repeats USING (rn) LEFT JOIN lost USING (rn)
), failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (removed_words = 0 OR (n_words - removed_words >= 10 AND 100 * (n_words - removed_words) >= 30 * n_words)) AS kept,
  removed_words
FROM failed
"""
