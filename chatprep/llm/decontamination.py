"""Benchmark decontamination by a prefix-filtered set join.

Every item gives windows of ten consecutive words (one shorter window if it has fewer).
Containment asks for all tokens of a window, so one token of each is a necessary prefix:
the rarest one, by the number of documents that hold it.  Document words are joined with
those tokens only; a match fixes where the window would start, the length and position
bounds drop windows that would stand out of the document, and what remains is compared
word by word.

Texts are cut into words once, and the words stored.  The prefixes are broadcast when they
are counted to be 200,000 or fewer; then a document gives rows for its own matches only.
Beyond that, places and tokens are shuffled to the prefixes (a few bytes a word, never the
words of the document), the matches are folded per document and text, and the words are
read again, once per document, to verify them.  A passage that a third of all documents
quote costs its occurrences and no more.

Null and empty texts have no words and no hits.  Items without id or words are left out;
an id that occurs twice counts once.  Repeated document rows get equal results.  Without
items nothing is contaminated; without documents the result is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import BROADCAST_ROWS, broadcast_if_small, fresh, group_key, lower_ascii, read_table, split_words, stage, staged_tables

# Word characters are digits, letters a-z and everything beyond ASCII.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def content_words(text: Column) -> Column:
    return split_words(lower_ascii(text), BREAKS)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(window_id, item_ids as rows) stored: window_id, item_id, words of every distinct window."""
    words = items.filter("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), content_words(F.col("text")).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    pairs = (
        words.filter(F.size("w") > 0)
        .select("item_id", "w", F.explode(starts).alias("at"))
        .select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("words"))
        .distinct()
    )
    return stage(pairs.withColumn("window_id", F.sha2(F.array_join("words", " "), 256)), "item-windows")


def document_words(docs: DataFrame) -> DataFrame:
    """(doc_id, key, digest, w, n_words) of every document, stored: the one pass that cuts texts into words."""
    rows = docs.select("doc_id", group_key(F.col("doc_id")).alias("key"), F.xxhash64("text").alias("digest"), content_words(F.col("text")).alias("w"))
    return stage(rows.withColumn("n_words", F.size("w").cast("bigint")), "document-words")


def rarest_tokens(windows: DataFrame, words: DataFrame) -> DataFrame:
    """(token, place, size, words, window_id): the necessary prefix of each distinct window."""
    distinct = windows.dropDuplicates(["window_id"]).select("window_id", "words")
    vocabulary = distinct.select(F.explode("words").alias("token")).distinct()
    held = words.select(F.explode(F.array_distinct("w")).alias("token"))
    spread = held.join(broadcast_if_small(vocabulary), "token").groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    places = distinct.select("window_id", F.posexplode("words").alias("place", "token"))
    rarity = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "place")
    first = places.join(spread, "token", "left").groupBy("window_id").agg(F.min(rarity).alias("first"))
    return stage(
        first.join(distinct, "window_id").select("first.token", "first.place", F.size("words").alias("size"), "words", "window_id"),
        "prefix-tokens",
    )


def window_hits(words: DataFrame, tokens: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(key, digest, start, size, window_id) of every occurrence; start counts from 1."""
    small = tokens.limit(limit + 1).count() <= limit
    held = ["w"] if small else []
    spots = words.select("key", "digest", "n_words", *held, F.posexplode("w").alias("pos", "token"))
    start = F.col("pos") - F.col("place") + 1
    met = spots.join(F.broadcast(tokens) if small else tokens.hint("merge"), "token")
    met = met.filter((start >= 1) & (start + F.col("size") - 1 <= F.col("n_words")))
    if small:
        met = met.filter(F.slice("w", start, F.col("size")) == F.col("words"))
        return met.select("key", "digest", start.alias("start"), "size", "window_id")
    claim = F.struct(start.alias("start"), "size", "window_id", "words")
    claims = met.groupBy("key", "digest").agg(F.collect_set(claim).alias("claims"))
    texts = words.groupBy("key", "digest").agg(F.first("w").alias("w"))
    true = F.filter("claims", lambda c: F.slice("w", c["start"], c["size"]) == c["words"])
    found = texts.join(claims, ["key", "digest"]).select("key", "digest", F.explode(true).alias("c"))
    return found.select("key", "digest", "c.start", "c.size", "c.window_id")


def contamination(words: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(key, digest, n_hit, item_ids sorted) of every document text with a hit, from ``document_words``."""
    windows = item_windows(items, window)
    hits = stage(window_hits(words, rarest_tokens(windows, words), limit), "window-hits")
    reach = F.flatten(F.transform(F.collect_set(F.struct("start", "size")), lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1)))
    covered = hits.groupBy("key", "digest").agg(F.size(F.array_distinct(reach)).cast("bigint").alias("n_hit"))
    named = hits.select("key", "digest", "window_id").distinct().join(windows.select("window_id", "item_id"), "window_id")
    items_of = named.groupBy("key", "digest").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    return covered.join(items_of, ["key", "digest"])


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` with no word inside a benchmark window."""
    with staged_tables() as tables:
        found = contamination(document_words(docs), read_table(spark, sf_dir, "benchmark"))
        dirty = tables.keep(stage(found.select("key", "digest"), "contaminated"))
    key, digest = fresh(docs, "deco_key"), fresh(docs, "deco_digest")
    dirty = dirty.select(F.col("key").alias(key), F.col("digest").alias(digest))
    marked = docs.withColumn(key, group_key(F.col("doc_id"))).withColumn(digest, F.xxhash64("text"))
    return marked.join(dirty, [key, digest], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = document_words(read_table(spark, sf_dir, "documents"))
    found = contamination(words, read_table(spark, sf_dir, "benchmark"))
    rows = words.select("doc_id", "key", "digest", "n_words")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return rows.join(found, ["key", "digest"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[st:st + 9], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS st FROM i WHERE len(w) > 0)
), spots AS (
  SELECT rn, start, size, array_to_string(w[start:start + size - 1], ' ') AS words
  FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS start FROM d) s, (SELECT DISTINCT size FROM windows) z
  WHERE start + size - 1 <= len(w)
), hits AS (
  SELECT rn, start, s.size, item_id FROM spots s JOIN windows v ON s.words = v.words AND s.size = v.size
), covered AS (
  SELECT rn, count(DISTINCT p) AS n_hit
  FROM (SELECT rn, unnest(range(start, start + size)) AS p FROM (SELECT DISTINCT rn, start, size FROM hits)) GROUP BY rn
), named AS (
  SELECT rn, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rn, item_id FROM hits) GROUP BY rn
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (rn) LEFT JOIN named USING (rn)
"""
