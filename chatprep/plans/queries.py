"""One query per operator over the test tables; each takes ``(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from chatprep.functions.conversations import sharegpt_turns
from chatprep.operators.documents import build_documents, extract_category, extract_facts
from chatprep.operators.index import build_index, document_frequency, idf_table, term_counts
from chatprep.operators.merge import MERGED_FROM, ORDER, merge_pairs, merge_same_user, merge_same_user_pairs
from chatprep.operators.normalize import (
    messages_to_pairs,
    messages_to_sharegpt,
    non_pairs,
    normalize_conversations,
    pairs_to_messages,
    resolve_columns,
    sharegpt_to_messages,
    with_default_system,
)
from chatprep.operators.quality import (
    dedup_conversations,
    drop_blank_pairs,
    duplicate_rows,
    flag_too_long,
    reject_unusable,
    split_valid,
    tag_conversations,
    validate_conversations,
)
from chatprep.operators.render import learned_total, render_chat_text, response_mask_report
from chatprep.operators.search import asked_terms, lookup_idf, search_documents, search_index
from chatprep.operators.split import split_train_valid
from chatprep.operators.stats import dataset_stats, run_counters, size_guidance, with_lengths
from chatprep.plans.jobs import (
    build_dataset,
    prepare_from_csv_or_jsonl,
    render_training_text,
    search,
    validate_dataset,
)
from chatprep.staging import stage, staging_folder
from chatprep.sinks.documents import write_documents
from chatprep.sinks.writers import (
    in_order,
    read_index,
    with_place,
    write_index,
    write_jsonl,
    write_merged_csv,
)
from chatprep.sources.files import read_csv_records, read_pairs, read_records
from chatprep.sources.turns import chat_turns_to_conversations

SYSTEM = "Reply in short sentences and name your sources."

# Part rows used as pairs come after the conversations in order.
PAIRS_FROM = 10_000_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# The forms of questions whose subject is a category, and one that is none.
QUESTION_FORMS = [("おすすめの", "のお店"), ("神戸で", "を食べるなら"), ("", "が食べたい"), ("人気の", "のお店"), ("", "?")]


# Inputs ------------------------------------------------------------------------------


def _conversations(spark, folder):
    return chat_turns_to_conversations(table(spark, folder, "conversations"))


def _faulty_turns(spark, folder):
    """Every conversation five times: as it is and with one kind of fault each."""
    turns = table(spark, folder, "conversations")
    fault = F.col("fault")
    reply = F.col("role") == "assistant"
    return (
        turns.withColumn("fault", F.explode(F.sequence(F.lit(0), F.lit(4))))
        .filter(~((fault == 3) & (F.col("turn") == 0)))
        .select(
            (F.col("conv_id") * 5 + fault).alias("conv_id"),
            "turn",
            F.when((fault == 1) & reply, "bot")
            .when(fault == 4, "system")
            .otherwise(F.col("role"))
            .alias("role"),
            F.when((fault == 2) & reply, "\u3000\t").otherwise(F.col("text")).alias("text"),
        )
    )


def _checked(spark, folder):
    return validate_conversations(chat_turns_to_conversations(_faulty_turns(spark, folder)))


def _twice(conversations):
    """Every conversation and an equal copy after it."""
    copies = conversations.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(1))))
    return copies.select((F.col("seq") * 2 + F.col("copy")).alias("seq"), "messages")


def _kept(spark, folder):
    return split_valid(validate_conversations(_conversations(spark, folder)))[0]


def _part_pairs(spark, folder):
    """Every part as a question and answer: as it is, repeated and without an answer."""
    part = table(spark, folder, "part")
    answer = F.concat(
        F.lit("「"),
        F.col("p_name"),
        F.lit("」（特徴："),
        F.col("p_type"),
        F.lit("）https://example.com/p/"),
        F.col("p_size").cast("string"),
    )
    return part.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2)))).select(
        (F.col("p_partkey") * 3 + F.col("copy")).alias("seq"),
        F.lit(None).cast("string").alias("system"),
        F.concat(
            F.lit("神戸で"), "p_brand", F.col("p_size").cast("string"), F.lit("を食べるなら？")
        ).alias("user"),
        F.when(F.col("copy") < 2, answer).otherwise(F.lit(" \u3000")).alias("assistant"),
    )


def _filled_pairs(spark, folder):
    return drop_blank_pairs(_part_pairs(spark, folder)).select("seq", "user", "assistant")


def _knowledge_pairs(spark, folder):
    """Pairs with a name in the answer (parts) and pairs without (conversations)."""
    named = _filled_pairs(spark, folder)
    plain = messages_to_pairs(_conversations(spark, folder)).select(
        (F.col("seq") + F.lit(PAIRS_FROM)).alias("seq"), "user", "assistant"
    )
    return named.unionByName(plain)


def _documents(spark, folder):
    return table(spark, folder, "documents").select(F.col("doc_id").alias("doc_seq"), "text")


def _questions(spark, folder):
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _dialog(conversations, *columns):
    """Messages as one text, for comparison."""
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return conversations.select("seq", *columns, F.array_join(lines, "\n").alias("dialog"))


# Conversations -----------------------------------------------------------------------


def conversations_checked(spark, folder):
    return _checked(spark, folder).select(
        "seq", F.array_join("problems", "|").alias("problems")
    )


def conversations_rejects(spark, folder):
    return split_valid(_checked(spark, folder))[1]


def conversations_kept(spark, folder):
    return _dialog(split_valid(_checked(spark, folder))[0])


def dedup_kept(spark, folder):
    return _dialog(dedup_conversations(_twice(_conversations(spark, folder))), "copies")


def duplicates_dropped(spark, folder):
    return duplicate_rows(_twice(_conversations(spark, folder))).select("seq")


def conversation_lengths(spark, folder):
    return with_lengths(_conversations(spark, folder)).select("seq", "chars", "tokens")


def too_long(spark, folder):
    return flag_too_long(_conversations(spark, folder), 64).select("seq", "too_long")


def default_system(spark, folder):
    return _dialog(with_default_system(_conversations(spark, folder), f" {SYSTEM}\u3000"))


def sharegpt_rows(spark, folder):
    rows = messages_to_sharegpt(_conversations(spark, folder))
    return rows.select("seq", F.posexplode("conversations").alias("pos", "turn")).select(
        "seq", "pos", F.col("turn.from").alias("speaker"), F.col("turn.value").alias("value")
    )


def sharegpt_round_trip(spark, folder):
    rows = messages_to_sharegpt(chat_turns_to_conversations(table(spark, folder, "conversations")))
    return _dialog(sharegpt_to_messages(rows))


def flat_pairs(spark, folder):
    return messages_to_pairs(_conversations(spark, folder))


def non_pair_conversations(spark, folder):
    return _dialog(non_pairs(_conversations(spark, folder)))


def json_shapes(spark, folder):
    """Each conversation as a chat object and as a ShareGPT object, read as raw JSON."""
    conversations = _faulty_turns(spark, folder)
    assembled = chat_turns_to_conversations(conversations)
    chat = F.to_json(F.struct(F.col("messages")))
    sharegpt = F.to_json(F.struct(sharegpt_turns(F.col("messages")).alias("conversations")))
    shapes = assembled.select("seq", F.posexplode(F.array(chat, sharegpt)).alias("shape", "raw"))
    records = shapes.select((F.col("seq") * 2 + F.col("shape")).alias("seq"), "raw")
    return _dialog(normalize_conversations(records))


def json_pairs(spark, folder):
    """Each part as a flat JSON object under other accepted names."""
    pairs = _part_pairs(spark, folder)
    raw = F.to_json(
        F.struct(
            F.col("user").alias("Question"), F.col("assistant").alias("OUTPUT"), F.col("seq")
        )
    )
    return _dialog(normalize_conversations(pairs.select("seq", raw.alias("raw")), SYSTEM))


def unusable_records(spark, folder):
    """The JSON properties of events hold no question and answer."""
    events = table(spark, folder, "events")
    records = events.select(F.col("event_id").alias("seq"), F.col("props").alias("raw"))
    return reject_unusable(normalize_conversations(records))[1]


def named_columns(spark, folder):
    pairs = _part_pairs(spark, folder)
    records = pairs.select(
        "seq",
        F.col("assistant").alias("Completion"),
        F.lit("not used").alias("input"),
        F.col("user").alias("Prompt"),
    )
    return resolve_columns(records)


# Statistics --------------------------------------------------------------------------


def dataset_statistics(spark, folder):
    return dataset_stats(_kept(spark, folder))


def counters(spark, folder):
    return run_counters(
        tag_conversations(validate_conversations(_twice(_checked(spark, folder))))
    )


def guidance(spark, folder):
    """Advice for the conversations of each length taken as a data set."""
    lengths = with_lengths(_conversations(spark, folder))
    stats = lengths.groupBy(F.size("messages").alias("turns")).agg(
        F.count(F.lit(1)).alias("count"), F.max("tokens").alias("max_tokens")
    )
    return size_guidance(stats, 64)


def split_sizes(spark, folder):
    kept = stage(_kept(spark, folder).select("seq"), "kept")
    split = split_train_valid(kept)
    both = split.train.join(split.valid, "seq")
    sides = [("train", split.train), ("valid", split.valid), ("both", both)]
    counted = [
        side.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n")
        for name, side in sides
    ]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


# Merging -----------------------------------------------------------------------------


def merged_pairs(spark, folder):
    pairs = _part_pairs(spark, folder)
    stripped = resolve_columns(pairs)
    return merge_pairs(stripped).rows.select("seq", "user", "assistant")


def merge_counters(spark, folder):
    return merge_pairs(resolve_columns(_part_pairs(spark, folder))).stats


def merged_conversations(spark, folder):
    plain = _conversations(spark, folder)
    asked = pairs_to_messages(_part_pairs(spark, folder)).withColumn(
        "seq", F.col("seq") + F.lit(PAIRS_FROM)
    )
    together = with_default_system(plain.unionByName(asked), SYSTEM)
    rows = merge_same_user(together, SYSTEM).rows
    # The SQL numbers merged rows from 2**62 on.
    merged = F.col("seq") >= F.lit(str(MERGED_FROM)).cast(ORDER)
    number = F.when(merged, F.col("seq") % F.lit(str(MERGED_FROM)).cast(ORDER) + F.lit(1 << 62)).otherwise(F.col("seq"))
    return _dialog(rows.withColumn("seq", number.cast("bigint")))


def merged_table(spark, folder):
    return merge_same_user_pairs(_part_pairs(spark, folder)).rows


# Facts and documents -----------------------------------------------------------------


def answer_facts(spark, folder):
    return extract_facts(_filled_pairs(spark, folder), "assistant").select(
        "seq", "name", "feature", "url"
    )


def question_category(spark, folder):
    return extract_category(_knowledge_pairs(spark, folder), "user").select("seq", "category")


def question_categories(spark, folder):
    """Every part asked for in each of the known forms, and in one that none matches."""
    part = table(spark, folder, "part").select("p_partkey", F.concat("p_brand", F.lit(" "), "p_size").alias("thing"))
    forms = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in QUESTION_FORMS])
    asked = part.select("p_partkey", "thing", F.posexplode(forms).alias("form", "f"))
    questions = asked.select("p_partkey", "form", F.concat("f.a", "thing", "f.b").alias("question"))
    return extract_category(questions, "question").select("p_partkey", "form", "category")


def knowledge_documents(spark, folder):
    return build_documents(_knowledge_pairs(spark, folder)).withColumn(
        "categories", F.array_join("categories", ",")
    )


# Retrieval ---------------------------------------------------------------------------


def benchmark_terms(spark, folder):
    return term_counts(_questions(spark, folder), "query_id", "text")


def document_idf(spark, folder):
    documents = _documents(spark, folder)
    counts = document_frequency(build_index(documents).frequencies)
    return idf_table(counts, documents).withColumn("idf", F.round("idf", 6))


def query_weights(spark, folder):
    """What each term of a question adds to a score, before the count in the document."""
    asked = stage(term_counts(_questions(spark, folder), "query_id", "text"), "query-terms")
    index = build_index(_documents(spark, folder), asked_terms(asked))
    weights = lookup_idf(asked, index.term_stats)
    return weights.withColumn("weight", F.round("weight", 6))


def _rounded(hits):
    return hits.withColumn("score", F.round("score", 6))


def search_topk(spark, folder):
    return _rounded(search_documents(_questions(spark, folder), _documents(spark, folder)))


def search_stored_index(spark, folder):
    path = _new_path(spark, "index")
    write_index(_documents(spark, folder), path)
    stored, _ = read_index(spark, path)
    return _rounded(search_index(_questions(spark, folder), stored))


def _shop_questions(spark, folder):
    """One question per brand, and one text no document shares a term with."""
    brands = table(spark, folder, "part").select("p_brand").distinct()
    asked = F.array(F.col("p_brand"), F.translate(F.col("p_brand"), "Brand#0123456789", "☆" * 16))
    return brands.select(F.posexplode(asked).alias("kind", "text"), "p_brand").select(
        F.concat("p_brand", F.lit("/"), F.col("kind").cast("string")).alias("query_id"), "text"
    )


def search_context(spark, folder):
    pairs = stage(_knowledge_pairs(spark, folder), "pairs")
    return search(_shop_questions(spark, folder), pairs, top_k=3)


def search_prompts(spark, folder):
    pairs = stage(_knowledge_pairs(spark, folder), "pairs")
    found = search(_shop_questions(spark, folder), pairs, top_k=3, prompts=True)
    return found.select(
        "query_id",
        F.get("messages", F.lit(0))["content"].alias("system_text"),
        F.get("messages", F.lit(1))["content"].alias("user_text"),
    )


# Rendering ---------------------------------------------------------------------------


def chat_text(spark, folder):
    return render_chat_text(_conversations(spark, folder)).select("seq", "text")


def learned(spark, folder):
    return learned_total(response_mask(spark, folder))


def response_mask(spark, folder):
    return response_mask_report(chat_turns_to_conversations(_faulty_turns(spark, folder)))


# Files and jobs ----------------------------------------------------------------------


def _as_file(spark, df, name):
    """The table as a JSON Lines folder in the shared staging folder."""
    path = f"{_new_path(spark, name)}.jsonl"
    write_jsonl(df, path)
    return path


def _new_path(spark, name):
    return f"{staging_folder(spark)}/{name}-{uuid4().hex}"


def json_lines_file(spark, folder):
    rows = in_order(messages_to_sharegpt(_conversations(spark, folder)), "seq")
    path = _as_file(spark, rows.select("conversations"), "sharegpt")
    return _dialog(normalize_conversations(read_records(spark, path))).select("dialog")


def json_list_file(spark, folder):
    """Lists of up to a hundred conversations, one JSON document per file."""
    rows = messages_to_sharegpt(_conversations(spark, folder))
    record = F.to_json(F.struct("conversations"))
    lists = rows.groupBy(F.floor(F.col("seq") / 100).alias("part")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(record), ","), F.lit("]")).alias("value")
    )
    path = f"{_new_path(spark, 'lists')}.json"
    lists.write.partitionBy("part").text(path)
    records = read_records(spark, path, layout="document")
    return _dialog(normalize_conversations(records, json=True)).select("dialog")


def json_object_file(spark, folder):
    """One file per conversation, holding a single object over several lines."""
    rows = messages_to_sharegpt(_conversations(spark, folder))
    value = F.concat(F.lit("{\n"), F.lit(' "conversations":\n'), F.to_json("conversations"), F.lit("\n}"))
    path = f"{_new_path(spark, 'objects')}.json"
    write_documents(rows.select(value.alias("value")), path)
    records = read_records(spark, path, layout="document")
    return _dialog(normalize_conversations(records, json=True)).select("dialog")


def csv_file(spark, folder):
    path = f"{_new_path(spark, 'pairs')}.csv"
    write_merged_csv(_part_pairs(spark, folder), path)
    return resolve_columns(read_csv_records(spark, path)).select("user", "assistant")


def csv_pairs(spark, folder):
    path = f"{_new_path(spark, 'pairs')}.csv"
    write_merged_csv(_part_pairs(spark, folder), path)
    return read_pairs(spark, path).select("user", "assistant")


def _conversation_file(spark, folder):
    rows = in_order(_twice(_conversations(spark, folder)), "seq")
    return _as_file(spark, rows.select("messages"), "messages")


def built_report(spark, folder):
    path = _conversation_file(spark, folder)
    return build_dataset(spark, path, _new_path(spark, "out"), system=SYSTEM).report


def built_sharegpt(spark, folder):
    path, out = _conversation_file(spark, folder), _new_path(spark, "out")
    build_dataset(spark, path, out, system=SYSTEM)
    written = normalize_conversations(read_records(spark, f"{out}/train_sharegpt.jsonl"))
    return _dialog(written).select("dialog")


def built_merged(spark, folder):
    """A build that merges: conversations, and parts that are asked for several times."""
    asked = pairs_to_messages(_part_pairs(spark, folder)).withColumn("seq", F.col("seq") + F.lit(PAIRS_FROM))
    rows = in_order(_conversations(spark, folder).unionByName(asked), "seq")
    path, out = _as_file(spark, rows.select("messages"), "messages"), _new_path(spark, "out")
    build_dataset(spark, path, out, system=SYSTEM, merge_same_user=True)
    written = normalize_conversations(read_records(spark, f"{out}/train_sharegpt.jsonl"))
    return _dialog(written).select("dialog")


def written_order(spark, folder):
    """The place of every conversation in the training file: that of its first copy."""
    path, out = _conversation_file(spark, folder), _new_path(spark, "out")
    build_dataset(spark, path, out, system=SYSTEM)
    written = read_records(spark, f"{out}/train_sharegpt.jsonl")
    return with_place(_dialog(normalize_conversations(written)), "seq").select("place", "dialog")


def written_sides(spark, folder):
    """Lines of the three files, and how many conversations of the first are in one of the others."""
    path, out = _conversation_file(spark, folder), _new_path(spark, "out")
    build_dataset(spark, path, out, system=SYSTEM)
    whole, train, valid = (
        _dialog(normalize_conversations(read_records(spark, f"{out}/{name}.jsonl"))) for name in ("train_sharegpt", "train", "valid")
    )
    split = train.select("dialog").unionByName(valid.select("dialog"))
    sides = [("train_sharegpt", whole), ("train", train), ("valid", valid), ("found", whole.join(split.distinct(), "dialog"))]
    counted = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("side"), "n") for name, df in sides]
    return reduce(DataFrame.unionByName, counted)


def validation_passed(spark, folder):
    """A file in which nothing is wrong."""
    rows = in_order(_kept(spark, folder), "seq")
    path = _as_file(spark, rows.select("messages"), "messages")
    return validate_dataset(spark, path).report.select("count", "input_rows", "skipped", "duplicates", "passed")


def validation_report(spark, folder):
    return validate_dataset(spark, _conversation_file(spark, folder)).report.select(
        "count", "input_rows", "skipped", "duplicates", "passed"
    )


def rendered_file(spark, folder):
    text, _ = render_training_text(spark, _conversation_file(spark, folder))
    return text.select("text")


def rendered_mask(spark, folder):
    _, mask = render_training_text(spark, _conversation_file(spark, folder))
    return mask.select("learned_chars", "learned_tokens", "has_response")


def prepared_csv(spark, folder):
    path, out = f"{_new_path(spark, 'pairs')}.csv", _new_path(spark, "out")
    write_merged_csv(_part_pairs(spark, folder), path)
    written = prepare_from_csv_or_jsonl(spark, path, out)
    return _dialog(normalize_conversations(read_records(spark, written))).select("dialog")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        conversations_checked,
        conversations_rejects,
        conversations_kept,
        dedup_kept,
        duplicates_dropped,
        conversation_lengths,
        too_long,
        default_system,
        sharegpt_rows,
        sharegpt_round_trip,
        flat_pairs,
        non_pair_conversations,
        json_shapes,
        json_pairs,
        unusable_records,
        named_columns,
        dataset_statistics,
        counters,
        guidance,
        split_sizes,
        merged_pairs,
        merge_counters,
        merged_conversations,
        merged_table,
        answer_facts,
        question_category,
        question_categories,
        knowledge_documents,
        benchmark_terms,
        document_idf,
        query_weights,
        search_topk,
        search_stored_index,
        search_context,
        search_prompts,
        chat_text,
        response_mask,
        learned,
        json_lines_file,
        json_list_file,
        json_object_file,
        csv_file,
        csv_pairs,
        built_report,
        built_sharegpt,
        built_merged,
        written_order,
        written_sides,
        validation_report,
        validation_passed,
        rendered_file,
        rendered_mask,
        prepared_csv,
    ]
}
