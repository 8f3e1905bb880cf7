"""Conversations from a table with one row per turn."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chatprep.functions.conversations import message
from chatprep.functions.text import clean, fold
from chatprep.operators.groups import in_one_cell


def chat_turns_to_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` to ``seq, messages``; ``seq`` is the ``conv_id``.

    Turns are collected map-side first.  A conversation that no cell can hold fails with
    its id and size.
    """
    ordered = F.array_sort(
        F.collect_list(
            F.struct("turn", fold(F.col("role")).alias("role"), clean(F.col("text")).alias("content"))
        )
    )
    grouped = turns.groupBy("conv_id").agg(ordered.alias("_turns"), F.sum(F.length("text")).alias("_chars"))
    return grouped.select(
        F.col("conv_id").alias("seq"),
        in_one_cell(
            F.transform("_turns", lambda t: message(t["role"], t["content"])),
            F.col("_chars"),
            F.col("conv_id"),
        ).alias("messages"),
    )
