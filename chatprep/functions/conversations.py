"""Expressions over a ``messages`` column: ``array<struct<role,content>>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatprep.functions.text import clean, fold, token_estimate

MESSAGES_TYPE = "array<struct<role:string,content:string>>"

# Accepted roles, role names of the two layouts and problem texts.
ROLES = ["system", "user", "assistant"]
ROLE_OF_SPEAKER = {
    "human": "user",
    "user": "user",
    "gpt": "assistant",
    "assistant": "assistant",
    "system": "system",
}
SPEAKER_OF_ROLE = {"system": "system", "user": "human", "assistant": "gpt"}
EMPTY_CONVERSATION = "empty conversation / 会話が空です"
NO_TURNS = "no user/assistant turns / user・assistant の発話がありません"
MUST_START_WITH_USER = "conversation must start with the user / 会話は user から始めます"
MUST_END_WITH_ASSISTANT = (
    "conversation must end with the assistant / 会話は assistant で終えます"
)
MUST_ALTERNATE = "turns must alternate user/assistant / user と assistant を交互にします"
NO_PAIR = "could not find a question/answer pair / 質問と答えの組が見つかりません"


def message(role, content) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.struct(role.alias("role"), content.alias("content"))


def body(messages) -> Column:
    """The turns without system messages."""
    return F.filter(messages, lambda m: m["role"] != "system")


def has_system(messages) -> Column:
    return F.exists(messages, lambda m: m["role"] == "system")


def lookup(mapping: dict[str, str], key: Column) -> Column:
    chain = F
    for name, value in mapping.items():
        chain = chain.when(key == name, F.lit(value))
    return chain


def pair_messages(user: Column, assistant: Column, system: Column | None = None) -> Column:
    """``[system if non-blank, user, assistant]``, all stripped."""
    turns = F.array(message("user", clean(user)), message("assistant", clean(assistant)))
    if system is None:
        return turns
    return F.when(clean(system) == "", turns).otherwise(
        F.concat(F.array(message("system", clean(system))), turns)
    )


def sharegpt_messages(turns: Column) -> Column:
    """``array<struct<from,value>>`` to messages; turns of other speakers are dropped."""
    known = F.filter(turns, lambda t: fold(t["from"]).isin(list(ROLE_OF_SPEAKER)))
    return F.transform(
        known, lambda t: message(lookup(ROLE_OF_SPEAKER, fold(t["from"])), clean(t["value"]))
    )


def sharegpt_turns(messages) -> Column:
    """Messages to ``array<struct<from,value>>``."""
    return F.transform(
        messages,
        lambda m: F.struct(
            lookup(SPEAKER_OF_ROLE, m["role"]).alias("from"), m["content"].alias("value")
        ),
    )


def total(messages, measure) -> Column:
    """Sum of ``measure(content)`` over the messages."""
    return F.aggregate(
        messages,
        F.lit(0).cast("bigint"),
        lambda acc, m: acc + measure(m["content"]).cast("bigint"),
    )


def total_chars(messages) -> Column:
    return total(messages, F.length)


def total_tokens(messages) -> Column:
    return total(messages, token_estimate)


def problems(messages: Column) -> Column:
    """Every rule the conversation breaks, in checking order; empty when it is fine."""
    turns = body(messages)
    per_message = F.flatten(
        F.transform(
            messages,
            lambda m: F.array_compact(
                F.array(
                    F.when(
                        ~m["role"].isin(ROLES),
                        F.concat(F.lit("unknown role '"), m["role"], F.lit("' / 不明なrole")),
                    ),
                    F.when(
                        m["content"] == "",
                        F.concat(
                            F.lit("empty "),
                            m["role"],
                            F.lit(" message / "),
                            m["role"],
                            F.lit(" の中身が空です"),
                        ),
                    ),
                )
            ),
        )
    )
    out_of_turn = F.exists(
        F.transform(
            turns,
            lambda m, i: m["role"]
            != F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")),
        ),
        lambda wrong: wrong,
    )
    whole = F.when(F.size(turns) == 0, F.array(F.lit(NO_TURNS))).otherwise(
        F.array_compact(
            F.array(
                F.when(F.get(turns, F.lit(0))["role"] != "user", F.lit(MUST_START_WITH_USER)),
                F.when(
                    F.get(turns, F.size(turns) - 1)["role"] != "assistant",
                    F.lit(MUST_END_WITH_ASSISTANT),
                ),
                F.when(out_of_turn, F.lit(MUST_ALTERNATE)),
            )
        )
    )
    return F.when(F.size(messages) == 0, F.array(F.lit(EMPTY_CONVERSATION))).otherwise(
        F.concat(per_message, whole)
    )
