"""Checks, rejects and exact de-duplication of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatprep.functions.conversations import MESSAGES_TYPE, NO_PAIR, problems, total_tokens
from chatprep.functions.text import is_blank
from chatprep.staging import stage

# Different repeated conversations up to which their digests are broadcast (100 MB).
BROADCAST_GROUPS = 1_000_000


def drop_blank_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.filter(~is_blank("user") & ~is_blank("assistant"))


def reject_unusable(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(with messages, rejects): records in which no pair was found."""
    usable = conversations.filter(F.col("messages").isNotNull())
    rejects = conversations.filter(F.col("messages").isNull()).select(
        "seq", F.lit(NO_PAIR).alias("reason")
    )
    return usable, rejects


def validate_conversations(conversations: DataFrame) -> DataFrame:
    """Add ``problems``: every broken rule in order, empty when the conversation is fine."""
    return conversations.withColumn(
        "problems",
        F.when(F.col("messages").isNull(), F.array(F.lit(NO_PAIR))).otherwise(
            problems(F.col("messages"))
        ),
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, rejects with the first problem as ``reason``)."""
    kept = checked.filter(F.size("problems") == 0).drop("problems")
    rejects = checked.filter(F.size("problems") > 0).select(
        "seq", F.get("problems", F.lit(0)).alias("reason")
    )
    return kept, rejects


def _repeated(conversations: DataFrame, digest: str, limit: int) -> DataFrame | None:
    """``digest, first, copies`` of the conversations that occur twice or more, if there are
    no more than the limit of different ones.

    Digests travel, texts do not; repeats are combined map-side.
    """
    counts = conversations.groupBy(digest).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("copies"))
    found = stage(counts.filter(F.col("copies") > 1), "repeated")
    return found if found.limit(limit + 1).count() <= limit else None


def _first_of_each(conversations: DataFrame, digest: str, repeated: DataFrame) -> DataFrame:
    """Adds ``copies`` and drops all but the first of each repeated conversation, in place."""
    joined = conversations.join(F.broadcast(repeated), digest, "left")
    first = F.col("first").isNull() | (F.col("first") == F.col("seq"))
    return joined.filter(first).withColumn("copies", F.coalesce("copies", F.lit(1).cast("bigint")))


def message_digest(messages: Column) -> Column:
    """SHA-256 of the messages: equal digests stand for equal messages."""
    return F.sha2(F.coalesce(F.to_json(messages), F.lit("")), 256)


def dedup_conversations(kept: DataFrame, limit: int = BROADCAST_GROUPS) -> DataFrame:
    """First of each set of equal conversations by ``seq``, with the number of ``copies``.

    Only digests are shuffled, and the repeated ones (different ones, however many copies
    each has) go to the texts.  Where those are more than the limit, texts are grouped:
    copies then meet as partial counts, so a conversation repeated a billion times sends
    one row per map task.
    """
    # Stored once; counting then reads the digests alone.
    marked = stage(kept.withColumn("_digest", message_digest(F.col("messages"))), "digests")
    repeated = _repeated(marked, "_digest", limit)
    if repeated is not None:
        return _first_of_each(marked, "_digest", repeated).select("seq", "messages", "copies")
    return marked.groupBy("messages").agg(
        F.min("seq").alias("seq"), F.count(F.lit(1)).alias("copies")
    ).select("seq", "messages", "copies")


def duplicate_rows(kept: DataFrame) -> DataFrame:
    """The rows ``dedup_conversations`` drops; joined on ``seq``, which has no hot key."""
    return kept.join(dedup_conversations(kept).select("seq"), "seq", "left_anti")


def tag_conversations(checked: DataFrame, limit: int = BROADCAST_GROUPS) -> DataFrame:
    """Checked conversations to their outcome, de-duplicated like ``dedup_conversations``.

    ``seq, messages, reason, copies``: ``reason`` is null for kept conversations;
    rejects keep a row each, without their text.  The texts are stored once, and what is
    read from the result comes from there.
    """
    reason = F.get("problems", F.lit(0))
    told = checked.select("seq", F.when(reason.isNull(), F.col("messages")).alias("messages"), reason.alias("reason"))
    # Rejects are told apart by their number.
    digest = F.when(F.col("reason").isNull(), message_digest(F.col("messages"))).otherwise(F.col("seq").cast("string"))
    marked = stage(told.withColumn("_digest", digest), "checked")
    repeated = _repeated(marked, "_digest", limit)
    if repeated is not None:
        first = _first_of_each(marked, "_digest", repeated)
        return first.select("seq", F.col("messages").cast(MESSAGES_TYPE), "reason", "copies")
    grouped = (
        marked.withColumn("_reject", F.when(F.col("reason").isNotNull(), F.col("seq")))
        .groupBy("messages", "reason", "_reject")
        .agg(F.min("seq").alias("seq"), F.count(F.lit(1)).alias("copies"))
        .select("seq", F.col("messages").cast(MESSAGES_TYPE), "reason", "copies")
    )
    return stage(grouped, "tagged")


def flag_too_long(conversations: DataFrame, max_seq_length: int = 1024) -> DataFrame:
    """Add ``too_long``; the rows stay."""
    return conversations.withColumn(
        "too_long", total_tokens(F.col("messages")) > F.lit(max_seq_length)
    )
