"""Ranked retrieval for whole tables of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from chatprep.functions.conversations import message
from chatprep.operators.grid import BLOCK_WEIGHTS, MOST_TASKS, block_scores, grid_scores, pack_postings
from chatprep.operators.groups import hot_keys, salted_join
from chatprep.operators.index import (
    Index,
    asked_postings,
    document_frequency,
    idf_table,
    spread_documents,
    spread_postings,
    term_counts,
)
from chatprep.staging import stage

# Different terms of all queries up to which they are sent to the tasks that count (8 MB).
SENT_TERMS = 1 << 18

# Hits (queries x k) up to which they are broadcast to the documents.
BROADCAST_HITS = 100_000

# Labels of a context block, the answer when nothing is found, and the
# prompt around question and context.
CATEGORY_LABEL = "ジャンル: "
FEATURE_LABEL = "特徴: "
MAP_LABEL = "地図: "
SOURCE_LABEL = "元データ: "
NOTHING_FOUND = "関連する情報がCSV内に見つかりませんでした。"
SYSTEM_TEXT = (
    "あなたは神戸の飲食店案内役です。必ず与えられたCSV検索結果だけを根拠に答えます。"
    "検索結果にない店名、特徴、URLは作らないでください。候補が複数ある場合は複数提示してください。"
)
QUESTION_TEMPLATE = "質問: {query}\n\nCSV検索結果:\n{context}\n\nこの情報だけで日本語で答えてください。"


def lookup_idf(query_terms: DataFrame, term_stats: DataFrame) -> DataFrame:
    """``query_id, term, weight``: query count times idf, for terms some document has."""
    return query_terms.join(term_stats, "term").select(
        "query_id", "term", (F.col("tf") * F.col("idf")).alias("weight")
    )


def numbered_terms(query_terms: DataFrame) -> DataFrame:
    """``term, tid``: the distinct terms that queries ask for, stored with a number each."""
    return stage(query_terms.select("term").distinct().withColumn("tid", F.monotonically_increasing_id()), "asked-terms")


def few_terms(terms: DataFrame) -> bool:
    """Are these terms so few that they are sent to the tasks?"""
    return terms.limit(SENT_TERMS + 1).count() <= SENT_TERMS


def asked_terms(query_terms: DataFrame) -> DataFrame:
    """``term``: the distinct terms that queries (a stored table) ask for, to be broadcast if they are few."""
    terms = query_terms.select("term").distinct()
    return F.broadcast(terms) if few_terms(terms) else terms


def _numbered_weights(query_terms: DataFrame, term_stats: DataFrame, terms: DataFrame) -> DataFrame:
    """``query_id, tid, weight``, stored."""
    weights = lookup_idf(query_terms, term_stats).join(terms, "term").select("query_id", "tid", "weight")
    return stage(weights, "query-weights")


def score_documents(
    query_terms: DataFrame,
    postings: DataFrame,
    term_stats: DataFrame,
    k: int | None = None,
    *,
    terms: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """``query_id, doc_seq, score`` for every pair that shares a term.

    With ``k`` only the best ``k`` documents per query and bucket of documents.  Queries
    are cut into blocks of about ``BLOCK_WEIGHTS`` terms and documents into ``buckets``;
    pairs are scored and ranked where a block and a bucket meet.
    """
    terms = numbered_terms(query_terms) if terms is None else terms
    weights = _numbered_weights(query_terms, term_stats, terms)
    asked = postings if "tid" in postings.columns else postings.join(terms, "term")
    blocks = max(1, -(-weights.count() // BLOCK_WEIGHTS))
    buckets = buckets or int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(1, min(buckets, MOST_TASKS // blocks))  # many blocks are tasks enough
    return grid_scores(weights, asked.select("doc_seq", "tid", "tf"), blocks, buckets, k)


def top_k(scores: DataFrame, k: int = 6) -> DataFrame:
    """Best ``k`` documents per query; equal scores keep document order.

    The rank filter becomes a per-partition group limit ahead of the shuffle.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    best_first = Window.partitionBy("query_id").orderBy(
        F.round("score", 9).desc(), F.col("doc_seq")
    )
    return (
        scores.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "doc_seq", "score")
    )


def search_documents(queries: DataFrame, documents: DataFrame, k: int = 6) -> DataFrame:
    """Hits of ``query_id, text`` in ``doc_seq, text``, without a saved index.

    Texts are spread by ``doc_seq`` once and a document is counted in one task.  Only
    postings of the queries' terms go on; document frequencies and scores share them.
    """
    query_terms = stage(term_counts(queries, "query_id", "text"), "query-terms")
    terms = numbered_terms(query_terms)
    spread, tasks = spread_documents(documents)
    if few_terms(terms):
        postings = asked_postings(spread, {r["term"]: r["tid"] for r in terms.collect()})
    else:
        postings = pack_postings(_asked(spread_postings(spread), terms))
    postings = stage(postings, "asked-postings")
    each = postings.select(F.explode("tid").alias("tid"), F.lit(1).alias("tf"))
    stats = idf_table(document_frequency(each, "tid").join(terms, "tid"), documents)
    # Scoring has more to do per document than counting, hence twice the tasks.
    return top_k(score_documents(query_terms, postings, stats, k, terms=terms, buckets=2 * tasks), k)


def search_index(queries: DataFrame, index: Index, k: int = 6) -> DataFrame:
    """Hits of ``query_id, text`` in an index.

    Of a stored index only the partitions of the queries' terms are read.
    """
    query_terms = stage(term_counts(queries, "query_id", "text"), "query-terms")
    terms = numbered_terms(query_terms)
    asked = index.of_terms(terms)
    terms = F.broadcast(terms) if few_terms(terms) else terms
    if asked.blocks is None:
        postings = _asked(asked.postings, terms)
        return top_k(score_documents(query_terms, postings, asked.term_stats, k, terms=terms), k)
    weights = _numbered_weights(query_terms, asked.term_stats, terms)
    held = asked.blocks.join(terms, "term").select("part", "block", "tid", "docs", "tfs")
    queries_in = max(1, -(-weights.count() // BLOCK_WEIGHTS))
    return top_k(block_scores(weights, held, queries_in, asked.parts, k), k)


def _asked(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings that some query asks for.

    An inner join with distinct terms: a semi join would be moved ahead of the counting of
    terms, to every single occurrence.  Spark broadcasts the terms if they are few.
    """
    return postings.join(terms, "term").select("doc_seq", "term", "tid", "tf")


def few_hits(queries: DataFrame, k: int, limit: int = BROADCAST_HITS) -> bool:
    """Are there so few queries that ``k`` hits of each stay within the limit?"""
    most = limit // max(k, 1)
    return queries.select("query_id").limit(most + 1).count() <= most


def attach_documents(hits: DataFrame, documents: DataFrame, *, small: bool) -> DataFrame:
    """Document fields for hits; ``small`` says the hits are known to be few (``few_hits``).

    Otherwise a document that many queries hit is joined in several tasks.
    """
    fields = documents.drop("text")
    if small:
        return fields.join(F.broadcast(hits), "doc_seq")
    counts = hits.groupBy("doc_seq").agg(F.count(F.lit(1)).alias("_hits"))
    return salted_join(hits, fields, "doc_seq", "query_id", hot_keys(counts, "doc_seq", "_hits"))


def make_context(found: DataFrame) -> DataFrame:
    """``query_id, context``: the hits of a query as text blocks in rank order."""

    def line(label, value):
        return F.when(value != "", F.concat(F.lit(label), value))

    block = F.concat_ws(
        "\n",
        F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), F.col("title")),
        line(CATEGORY_LABEL, F.array_join("categories", ", ")),
        line(FEATURE_LABEL, F.col("feature")),
        line(MAP_LABEL, F.col("url")),
        F.concat(F.lit(SOURCE_LABEL), F.col("answer")),
    )
    blocks = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))
    return found.groupBy("query_id").agg(
        F.array_join(F.transform(blocks, lambda b: b["block"]), "\n\n").alias("context")
    )


def answer_queries(
    queries: DataFrame, contexts: DataFrame, fallback: str = NOTHING_FOUND
) -> DataFrame:
    """Every query with its context, or the fixed text when nothing was found."""
    return queries.join(contexts, "query_id", "left").select(
        *queries.columns, F.coalesce("context", F.lit(fallback)).alias("answer")
    )


def build_prompts(
    queries: DataFrame,
    contexts: DataFrame,
    system_text: str = SYSTEM_TEXT,
    template: str = QUESTION_TEMPLATE,
) -> DataFrame:
    """``query_id, messages`` for the queries that have a context.

    ``{query}`` and ``{context}`` in the template stand for the two texts.
    """
    pieces = []
    for i, rest in enumerate(template.split("{query}")):
        if i:
            pieces.append(F.col("text"))
        for j, fixed in enumerate(rest.split("{context}")):
            if j:
                pieces.append(F.col("context"))
            pieces.append(F.lit(fixed))
    return queries.join(contexts, "query_id").select(
        "query_id",
        F.array(
            message("system", F.lit(system_text)), message("user", F.concat(*pieces))
        ).alias("messages"),
    )
