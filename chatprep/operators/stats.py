"""Lengths, data-set statistics and counters; results are one-row tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatprep.functions.conversations import total_chars, total_tokens


def with_lengths(conversations: DataFrame) -> DataFrame:
    """Add ``chars`` and the token estimate ``tokens``."""
    return conversations.withColumns(
        {"chars": total_chars(F.col("messages")), "tokens": total_tokens(F.col("messages"))}
    )


def dataset_stats(kept: DataFrame) -> DataFrame:
    """Count, averages (cut to integers), upper median and maxima; zeros when empty.

    Needs ``chars`` and ``tokens`` or ``messages``.  The exact median keeps one count per
    distinct length, added up map-side.
    """
    if not {"chars", "tokens"} <= set(kept.columns):
        kept = with_lengths(kept)
    n = F.count(F.lit(1))
    upper_median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY chars DESC)")
    zero = F.lit(0).cast("bigint")
    return kept.select("chars", "tokens").agg(
        n.alias("count"),
        *[
            F.coalesce(value.cast("bigint"), zero).alias(name)
            for name, value in [
                ("avg_chars", F.expr("sum(chars) DIV nullif(count(*), 0)")),
                ("median_chars", upper_median),
                ("max_chars", F.max("chars")),
                ("avg_tokens", F.expr("sum(tokens) DIV nullif(count(*), 0)")),
                ("max_tokens", F.max("tokens")),
            ]
        ],
    )


def run_counters(tagged: DataFrame) -> DataFrame:
    """``input_rows, skipped, duplicates`` of a tagged table (see ``tag_conversations``)."""
    kept = F.col("reason").isNull()
    zero = F.lit(0).cast("bigint")
    return tagged.agg(
        F.coalesce(F.sum("copies"), zero).alias("input_rows"),
        F.coalesce(F.sum(F.when(~kept, F.col("copies"))), zero).alias("skipped"),
        F.coalesce(F.sum(F.when(kept, F.col("copies") - 1)), zero).alias("duplicates"),
    )


def size_guidance(stats: DataFrame, max_seq_length: int = 1024) -> DataFrame:
    """How far a data set of this size carries; one row out per row in."""
    n = F.col("count")
    # Size limits and the epoch hints with their gaps.
    level = (
        F.when(n == 0, "error")
        .when(n < 10, "barely changes")
        .when(n < 30, "small")
        .otherwise("ok")
    )
    epochs = (
        F.when(n.between(30, 60), "8-10").when(n.between(100, 300), "4-6").when(n >= 500, "2-3")
    )
    return stats.select(
        *stats.columns,
        level.alias("level"),
        (F.col("max_tokens") > F.lit(max_seq_length)).alias("over_length"),
        epochs.alias("epochs"),
    )
