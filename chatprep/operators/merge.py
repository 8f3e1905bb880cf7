"""Several answers to the same question merged into one."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from chatprep.functions.answers import merged_answer
from chatprep.functions.conversations import pair_messages
from chatprep.functions.text import clean, is_blank
from chatprep.operators.groups import in_one_cell
from chatprep.operators.normalize import messages_to_pairs, non_pairs, with_default_system
from chatprep.operators.quality import drop_blank_pairs

# The order key of conversations is a decimal here, so that merged rows can follow all
# rows that pass through whatever those are numbered.
ORDER = "decimal(38,0)"
MERGED_FROM = 10**37

QUESTION = ["system", "user"]


def distinct_answers(pairs: DataFrame) -> DataFrame:
    """One row per question and answer: first ``seq`` and number of rows.

    Repeats are combined map-side, before any answer list exists.
    """
    return (
        _keyed(pairs)
        .groupBy(*QUESTION, "assistant")
        .agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("rows"))
    )


def _keyed(pairs: DataFrame) -> DataFrame:
    return pairs.select("seq", clean(F.col("system")).alias("system"), "user", "assistant")


def _merge(answers: DataFrame) -> DataFrame:
    """One row per question; answers are collected map-side and meet in its row only."""
    filled = ~is_blank("assistant")
    listed = F.array_sort(F.collect_list(F.when(filled, F.struct("seq", "assistant"))))
    grouped = answers.groupBy(*QUESTION).agg(
        F.min("seq").alias("seq"),
        F.transform(listed, lambda x: x["assistant"]).alias("_answers"),
        F.sum(F.when(filled, F.length("assistant") + 32)).alias("_chars"),
    )
    found = F.col("_answers")
    text = F.when(F.size(found) > 1, merged_answer(found)).otherwise(
        F.coalesce(F.get(found, F.lit(0)), F.lit(""))
    )
    return grouped.select(
        "seq", *QUESTION, in_one_cell(text, F.col("_chars"), F.col("seq")).alias("assistant")
    )


def merge_stats(pairs: DataFrame, passed: DataFrame | None = None) -> DataFrame:
    """One row: questions with two or more answers, their input rows, rows after merging."""
    groups = (
        distinct_answers(pairs)
        .groupBy(*QUESTION)
        .agg(
            F.count_if(~is_blank("assistant")).alias("_answers"), F.sum("rows").alias("_rows")
        )
        .agg(
            F.count_if(F.col("_answers") > 1).alias("merged_prompt_groups"),
            F.coalesce(
                F.sum(F.when(F.col("_answers") > 1, F.col("_rows"))), F.lit(0).cast("bigint")
            ).alias("merged_input_rows"),
            F.count(F.lit(1)).alias("rows_after_merge"),
        )
    )
    if passed is None:
        return groups
    none = F.lit(0).cast("bigint")
    passing = passed.agg(
        none.alias("merged_prompt_groups"),
        none.alias("merged_input_rows"),
        F.count(F.lit(1)).alias("rows_after_merge"),
    )
    return groups.unionByName(passing).agg(*[F.sum(c).alias(c) for c in groups.columns])


class Merged:
    """Result of merging ``seq, system, user, assistant`` pairs.

    * ``rows``: one row per (system, user)
    * ``stats``: the one-row counters

    Each plan is built when it is asked for.
    """

    def __init__(self, pairs: DataFrame):
        self.pairs = pairs

    @cached_property
    def rows(self) -> DataFrame:
        return _merge(distinct_answers(self.pairs))

    @cached_property
    def stats(self) -> DataFrame:
        return merge_stats(self.pairs)


def merge_pairs(pairs: DataFrame) -> Merged:
    """One row per (system, user) with the distinct answers in order."""
    return Merged(pairs)


class MergedConversations(Merged):
    """``rows`` are conversations: those that are no single pair first, then the merged."""

    def __init__(self, conversations: DataFrame, default_system: str | None):
        super().__init__(messages_to_pairs(conversations))
        self._passed = non_pairs(conversations)
        self._default_system = default_system

    @cached_property
    def rows(self) -> DataFrame:
        merged = _merge(distinct_answers(self.pairs)).select(
            (F.col("seq").cast(ORDER) + F.lit(str(MERGED_FROM)).cast(ORDER)).cast(ORDER).alias("seq"),
            pair_messages(F.col("user"), F.col("assistant"), F.col("system")).alias("messages"),
        )
        passed = self._passed.select(F.col("seq").cast(ORDER).alias("seq"), "messages")
        return passed.unionByName(with_default_system(merged, self._default_system))

    @cached_property
    def stats(self) -> DataFrame:
        return merge_stats(self.pairs, self._passed)


def merge_same_user(
    conversations: DataFrame, default_system: str | None = None
) -> MergedConversations:
    """Merge the single question/answer conversations that share system and question.

    Conversations must already carry the default system message; it is added again where
    merging left none.
    """
    return MergedConversations(conversations, default_system)


def merge_same_user_pairs(pairs: DataFrame) -> Merged:
    """The table variant: blank pairs are dropped before merging.

    ``rows`` is the input unchanged when no question has two answers.  ``system`` is a
    column of the result only if some row has one.
    """
    with_system = "system" in pairs.columns
    system = clean(F.col("system")) if with_system else F.lit("")
    merged = Merged(
        drop_blank_pairs(
            pairs.select(
                "seq",
                system.alias("system"),
                clean(F.col("user")).alias("user"),
                clean(F.col("assistant")).alias("assistant"),
            )
        )
    )
    # Two one-row questions that decide the shape of the result.
    if merged.stats.first()["merged_prompt_groups"] == 0:
        merged.rows = pairs
    elif merged.pairs.filter(F.col("system") != "").isEmpty():
        merged.rows = merged.rows.select("seq", "user", "assistant")
    else:
        merged.rows = merged.rows.select("seq", "user", "assistant", "system")
    return merged
