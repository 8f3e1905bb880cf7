"""Training text of conversations and the part of it that is learned."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatprep.functions.conversations import total_chars, total_tokens

# Turn markers and the name the assistant goes by in rendered text.
TURN_OPEN = "<|turn>"
TURN_CLOSE = "<turn|>"
ASSISTANT_LABEL = "model"


def render_chat_text(
    conversations: DataFrame,
    *,
    turn_open: str = TURN_OPEN,
    turn_close: str = TURN_CLOSE,
    assistant_label: str = ASSISTANT_LABEL,
) -> DataFrame:
    """Add ``text``: one string with all turns between their markers.

    Conversations without messages have no text and are left out.
    """
    turns = F.transform(
        "messages",
        lambda m: F.concat(
            F.lit(turn_open),
            F.when(m["role"] == "assistant", F.lit(assistant_label)).otherwise(m["role"]),
            F.lit("\n"),
            m["content"],
            F.lit(turn_close),
            F.lit("\n"),
        ),
    )
    usable = conversations.filter(F.col("messages").isNotNull())
    return usable.withColumn("text", F.array_join(turns, ""))


def response_mask_report(conversations: DataFrame) -> DataFrame:
    """How much of each conversation is learned when only replies count.

    Nothing is learned of a conversation without messages.
    """
    replies = F.filter("messages", lambda m: m["role"] == "assistant")
    chars = F.coalesce(total_chars(replies), F.lit(0))
    return conversations.select(
        "seq",
        chars.alias("learned_chars"),
        F.coalesce(total_tokens(replies), F.lit(0)).alias("learned_tokens"),
        (chars > 0).alias("has_response"),
    )


def learned_total(report: DataFrame) -> DataFrame:
    """One row of a mask report: conversations, those with replies, and whether anything is learned."""
    tokens = F.coalesce(F.sum("learned_tokens"), F.lit(0))
    return report.agg(
        F.count(F.lit(1)).alias("conversations"),
        F.count_if("has_response").alias("with_response"),
        tokens.alias("learned_tokens"),
        (tokens > 0).alias("passed"),
    )
