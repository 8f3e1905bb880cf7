"""Records of any accepted layout to one message schema, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatprep.functions.conversations import (
    MESSAGES_TYPE,
    body,
    has_system,
    message,
    pair_messages,
    sharegpt_messages,
    sharegpt_turns,
)
from chatprep.functions.text import clean, fold

# Accepted column names, by priority.
USER_NAMES = ["user", "instruction", "question", "prompt", "input"]
ASSISTANT_NAMES = ["assistant", "response", "answer", "completion", "output"]
SYSTEM_NAMES = ["system", "persona", "instructions"]


def prepare_session(spark: SparkSession) -> None:
    """JSON objects with a repeated key are legal; the last one counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def resolve_columns(records: DataFrame) -> DataFrame:
    """Name the question, answer and system columns ``user, assistant, system``, stripped.

    A column without any accepted name is left out of the result.
    """
    by_name = {c.lower(): c for c in records.columns}
    found = {}
    for role, names in [
        ("user", USER_NAMES),
        ("assistant", ASSISTANT_NAMES),
        ("system", SYSTEM_NAMES),
    ]:
        match = next((by_name[n] for n in names if n in by_name), None)
        if match is not None:
            found[role] = clean(F.col(f"`{match}`")).alias(role)
    return records.select("seq", *found.values())


def pairs_to_messages(pairs: DataFrame) -> DataFrame:
    system = F.col("system") if "system" in pairs.columns else None
    return pairs.select(
        "seq", pair_messages(F.col("user"), F.col("assistant"), system).alias("messages")
    )


def _is_object(variant: Column) -> Column:
    # Not by the schema: that spells out all that is in the value.
    return F.try_variant_get(variant, "$", "map<string,variant>").isNotNull()


def _is_list(variant: Column) -> Column:
    return F.try_variant_get(variant, "$", "array<variant>").isNotNull()


def _as_text(text: Column, variant: Column) -> Column:
    """Scalar text; booleans are written with a capital letter."""
    # Other texts than these two are never looked up in the variant.
    boolean = text.isin("true", "false") & (F.schema_of_variant(variant) == "BOOLEAN")
    spelled = F.when(boolean, F.initcap(text)).otherwise(text)
    return F.coalesce(spelled, F.lit(""))


def _turn_pairs(list_text: Column, list_variant: Column, first: str, second: str) -> Column:
    """A JSON list as ``array<struct<fields,kind>>``: each turn's text parsed once, its kinds aside.

    The text is kept next to the variant because the variant alone rewrites numbers.
    Turns that are no objects are dropped.
    """
    both = F.arrays_zip(
        F.from_json(list_text, "array<string>").alias("text"),
        F.try_variant_get(list_variant, "$", "array<variant>").alias("kind"),
    )
    fields = f"struct<`{first}`:string,`{second}`:string>"
    return F.transform(
        F.filter(both, lambda t: _is_object(t["kind"])),
        lambda t: F.struct(F.from_json(t["text"], fields).alias("fields"), t["kind"].alias("kind")),
    )


def _turns(pairs: Column, first: str, second: str) -> Column:
    """Parsed turns to ``array<struct<first,second>>`` of text."""

    def field(turn, name):
        kind = F.try_variant_get(turn["kind"], f"$.{name}", "variant")
        return _as_text(turn["fields"][name], kind).alias(name)

    return F.transform(pairs, lambda t: F.struct(field(t, first), field(t, second)))


def _entry(entries: Column, names: list[str]) -> Column:
    """The entry that gives a role its value: first accepted name, and of that the last key.

    Presence of the key decides, so a null value under it still wins.
    """
    accepted = F.array(*[F.lit(n) for n in names])
    placed = F.transform(
        entries,
        lambda e, i: F.struct(
            F.array_position(accepted, F.lower(e["key"])).alias("name"),
            (-i).alias("last"),
            e["key"].alias("key"),
            e["value"].alias("value"),
        ),
    )
    return F.array_min(F.filter(placed, lambda e: e["name"] > 0))


def _under(entries: Column, key: str) -> Column:
    """The last value under exactly this key."""
    hits = F.filter(entries, lambda e: e["key"] == key)
    return F.try_element_at(hits, F.lit(-1))["value"]


def _json_messages(records: DataFrame) -> DataFrame:
    """Every record is parsed once; each step is a table of its own, so that no parse is
    repeated where its result is used several times."""
    prepare_session(records.sparkSession)
    parsed = records.select(
        "seq",
        F.try_parse_json("raw").alias("_v"),
        F.map_entries(F.from_json("raw", "map<string,string>")).alias("_entries"),
    )
    entries = F.col("_entries")
    found = parsed.select(
        "seq",
        _is_object(F.col("_v")).alias("_object"),
        F.try_variant_get("_v", "$.messages", "variant").alias("_m"),
        F.try_variant_get("_v", "$.conversations", "variant").alias("_c"),
        F.try_variant_get("_v", "$", "map<string,variant>").alias("_kinds"),
        _under(entries, "messages").alias("_m_text"),
        _under(entries, "conversations").alias("_c_text"),
        _entry(entries, USER_NAMES).alias("_user"),
        _entry(entries, ASSISTANT_NAMES).alias("_assistant"),
        _entry(entries, SYSTEM_NAMES).alias("_system"),
    )

    def value(column):
        entry = F.col(column)
        text = _as_text(entry["value"], F.try_element_at("_kinds", entry["key"]))
        return F.when(entry.isNotNull(), text).alias(column)

    read = found.select(
        "seq",
        "_object",
        _is_list(F.col("_m")).alias("_is_m"),
        _is_list(F.col("_c")).alias("_is_c"),
        _turn_pairs(F.col("_m_text"), F.col("_m"), "role", "content").alias("_m"),
        _turn_pairs(F.col("_c_text"), F.col("_c"), "from", "value").alias("_c"),
        value("_user"),
        value("_assistant"),
        value("_system"),
    )
    chat = F.transform(
        _turns(F.col("_m"), "role", "content"),
        lambda x: message(fold(x["role"]), clean(x["content"])),
    )
    user, assistant, system = F.col("_user"), F.col("_assistant"), F.col("_system")
    pair = F.when(
        user.isNotNull() & assistant.isNotNull(), pair_messages(user, assistant, system)
    )
    return read.select(
        "seq",
        F.when(~F.col("_object"), F.lit(None).cast(MESSAGES_TYPE))
        .when(F.col("_is_m"), chat)
        .when(F.col("_is_c"), sharegpt_messages(_turns(F.col("_c"), "from", "value")))
        .otherwise(pair)
        .alias("messages"),
    )


def with_default_system(conversations: DataFrame, text: str | None) -> DataFrame:
    """Prepend a system message where the conversation has none."""
    if not text:
        return conversations
    messages = F.col("messages")
    added = F.concat(F.array(message("system", clean(F.lit(text)))), messages)
    return conversations.withColumn(
        "messages", F.when(has_system(messages), messages).otherwise(added)
    )


def normalize_conversations(
    records: DataFrame, default_system: str | None = None, *, json: bool | None = None
) -> DataFrame:
    """Records (``seq, raw`` or ``seq, <csv columns>``) to ``seq, messages``.

    ``messages`` is null where no question/answer pair was found.  ``json`` says whether
    ``raw`` holds JSON; without it a table of nothing but ``raw`` is taken for JSON.
    """
    if json is None:
        json = "raw" in records.columns and set(records.columns) <= {"seq", "source", "raw"}
    if json:
        conversations = _json_messages(records)
    else:
        pairs = resolve_columns(records)
        if {"user", "assistant"} <= set(pairs.columns):
            conversations = pairs_to_messages(pairs)
        else:
            conversations = pairs.select("seq", F.lit(None).cast(MESSAGES_TYPE).alias("messages"))
    return with_default_system(conversations, default_system)


def sharegpt_to_messages(turns: DataFrame) -> DataFrame:
    """``seq, conversations`` with ``{from, value}`` turns to ``seq, messages``."""
    return turns.select("seq", sharegpt_messages(F.col("conversations")).alias("messages"))


def messages_to_sharegpt(conversations: DataFrame) -> DataFrame:
    return conversations.select("seq", sharegpt_turns(F.col("messages")).alias("conversations"))


def with_pair(conversations: DataFrame) -> DataFrame:
    """Add ``pair`` = ``{system, user, assistant}``, null unless exactly one of each turn."""
    turns = body(F.col("messages"))
    question, answer = F.get(turns, F.lit(0)), F.get(turns, F.lit(1))
    system = F.get(
        F.filter(F.col("messages"), lambda m: m["role"] == "system"), F.lit(0)
    )["content"]
    single = (
        (F.size(turns) == 2) & (question["role"] == "user") & (answer["role"] == "assistant")
    )
    return conversations.withColumn(
        "pair",
        F.when(
            single,
            F.struct(
                F.nullif(system, F.lit("")).alias("system"),
                question["content"].alias("user"),
                answer["content"].alias("assistant"),
            ),
        ),
    )


def messages_to_pairs(conversations: DataFrame) -> DataFrame:
    """The conversations that are a single question and answer, as flat pairs."""
    return (
        with_pair(conversations)
        .filter(F.col("pair").isNotNull())
        .select("seq", "pair.system", "pair.user", "pair.assistant")
    )


def non_pairs(conversations: DataFrame) -> DataFrame:
    """The conversations ``messages_to_pairs`` leaves out."""
    return with_pair(conversations).filter(F.col("pair").isNull()).select("seq", "messages")
