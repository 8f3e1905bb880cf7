"""Knowledge documents from question/answer pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatprep.functions.facts import category, fact_feature, fact_name, fact_url
from chatprep.operators.groups import in_one_cell

KEY = ["_name"]
FIELDS = ["title", "categories", "feature", "url", "answer"]


def extract_facts(df: DataFrame, column: str) -> DataFrame:
    """Add ``name``, ``feature`` and ``url`` found in an answer, ``''`` where missing."""
    text = F.col(column)
    return df.withColumns(
        {"name": fact_name(text), "feature": fact_feature(text), "url": fact_url(text)}
    )


def extract_category(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("category", category(F.col(column)))


def _first_filled(column: str, order: str) -> Column:
    """First non-blank value by order; null when all are blank."""
    return F.min_by(column, F.when(F.col(column) != "", F.col(order)))


def _facts(order: str) -> list[Column]:
    return [
        F.min_by("title", order).alias("title"),
        _first_filled("feature", order).alias("feature"),
        _first_filled("url", order).alias("url"),
        F.min_by("answer", order).alias("answer"),
    ]


def _fields() -> list[Column]:
    return [
        F.col("doc_seq"),
        F.col("title"),
        F.col("categories"),
        F.coalesce("feature", F.lit("")).alias("feature"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.col("answer"),
    ]


def _filled(text) -> Column:
    return F.nullif(text, F.lit(""))


def _head() -> list[Column]:
    """The text lines before the questions; null ones are skipped by ``concat_ws``."""
    return [
        _filled(F.col("title")),
        _filled(F.array_join("categories", " ")),
        _filled(F.col("feature")),
        _filled(F.col("url")),
    ]


def _fact_rows(pairs: DataFrame) -> DataFrame:
    facts = extract_category(extract_facts(pairs, "assistant"), "user")
    return facts.select(
        F.col("name").alias("_name"),
        "seq",
        "user",
        F.when(F.col("name") == "", F.col("user")).otherwise(F.col("name")).alias("title"),
        "feature",
        "url",
        F.nullif("category", F.lit("")).alias("category"),
        F.col("assistant").alias("answer"),
    )


def _with_text(fields: DataFrame, questions: str) -> DataFrame:
    text = F.concat_ws("\n", *_head(), F.col(questions), F.col("answer"))
    return fields.select("doc_seq", *FIELDS, text.alias("text"))


def _unnamed(rows: DataFrame) -> DataFrame:
    """A row without a name is a document of its own: nothing to group."""
    single = rows.select(
        F.col("seq").alias("doc_seq"),
        "title",
        F.array_compact(F.array("category")).alias("categories"),
        "feature",
        "url",
        "answer",
        "user",
    )
    return _with_text(single, "user")


def _questions() -> Column:
    """All questions of a group in order, with repeats, as one text."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", "user")))
    return F.array_join(F.transform(ordered, lambda x: x["user"]), " ")


def _named(rows: DataFrame) -> DataFrame:
    """Rows of one name are collected map-side and meet in the document's row only."""
    grouped = rows.groupBy(*KEY).agg(
        F.min("seq").alias("doc_seq"),
        *_facts("seq"),
        F.array_sort(F.collect_set("category")).alias("categories"),
        _questions().alias("_questions"),
        F.sum(F.length("user") + 1).alias("_chars"),
    )
    whole = in_one_cell(F.col("_questions"), F.col("_chars"), F.col("_name")).alias("_questions")
    return _with_text(grouped.select(*_fields(), whole), "_questions")


def build_documents(pairs: DataFrame) -> DataFrame:
    """Group ``seq, user, assistant`` by the name in the answer: one row per document.

    Rows without a name are documents of their own and are never grouped.
    """
    rows = _fact_rows(pairs)
    unnamed = _unnamed(rows.filter(F.col("_name") == ""))
    return unnamed.unionByName(_named(rows.filter(F.col("_name") != "")))
