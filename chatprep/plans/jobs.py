"""User-level jobs."""

from __future__ import annotations

from contextlib import contextmanager
from pathlib import PurePosixPath
from typing import NamedTuple

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from chatprep.operators.documents import build_documents
from chatprep.operators.merge import merge_same_user, merge_same_user_pairs
from chatprep.operators.normalize import resolve_columns
from chatprep.operators.quality import tag_conversations, validate_conversations
from chatprep.operators.render import render_chat_text, response_mask_report
from chatprep.operators.search import (
    answer_queries,
    attach_documents,
    build_prompts,
    few_hits,
    make_context,
    search_documents,
    search_index,
)
from chatprep.operators.stats import dataset_stats, run_counters, size_guidance, with_lengths
from chatprep.sinks.writers import (
    read_index,
    write_index,
    write_merged_csv,
    write_training_bundle,
)
from chatprep.sources.files import (
    line_in_file,
    read_conversations,
    read_csv_records,
    read_pairs,
    read_training_json,
)
from chatprep.staging import stage


class Built(NamedTuple):
    """Result of a build: kept conversations, rejects with reason, one-row report and
    merge counters (None without merging)."""

    kept: DataFrame
    rejects: DataFrame
    report: DataFrame
    merge: DataFrame | None


@contextmanager
def _lines_named(spark: SparkSession, path: str):
    """A bad JSON line fails the job with its number in the file."""
    try:
        yield
    except PySparkException as error:
        told = line_in_file(spark, path, error)
        if told is None:
            raise
        raise ValueError(told) from error


def _tagged(conversations: DataFrame) -> DataFrame:
    """Checked and de-duplicated outcome of every conversation, with its lengths."""
    return with_lengths(tag_conversations(validate_conversations(conversations)))


def _report(tagged: DataFrame, max_seq_length: int) -> DataFrame:
    kept = tagged.filter(F.col("reason").isNull())
    # Both sides are one row.
    stats = size_guidance(dataset_stats(kept), max_seq_length)
    return stats.crossJoin(F.broadcast(run_counters(tagged)))


def _result(tagged: DataFrame, max_seq_length: int) -> Built:
    kept = tagged.filter(F.col("reason").isNull()).select("seq", "messages", "chars", "tokens")
    rejects = tagged.filter(F.col("reason").isNotNull()).select("seq", "reason")
    return Built(kept, rejects, _report(tagged, max_seq_length), None)


def build_dataset(
    spark: SparkSession,
    path: str,
    out: str = "out",
    *,
    system: str | None = None,
    valid_frac: float = 0.1,
    seed: int = 3407,
    max_seq_length: int = 1024,
    merge_same_user: bool = False,
    **read_options,
) -> Built:
    """Records of one file (or folder of part files) to training files in ``out``.

    Writes nothing when no conversation is kept.  ``read_options`` as in ``read_records``.
    """
    with _lines_named(spark, path):
        return build_from_conversations(
            read_conversations(spark, path, system, **read_options),
            out,
            system=system,
            valid_frac=valid_frac,
            seed=seed,
            max_seq_length=max_seq_length,
            merge=merge_same_user,
        )


def build_from_conversations(
    conversations: DataFrame,
    out: str,
    *,
    system: str | None = None,
    valid_frac: float = 0.1,
    seed: int = 3407,
    max_seq_length: int = 1024,
    merge: bool = False,
) -> Built:
    """The build behind ``build_dataset``, for conversations from any source."""
    merged = None
    if merge:
        # Merging reads its input several times.
        merged = merge_same_user(stage(conversations, "conversations"), system)
        conversations = merged.rows
    tagged = _tagged(conversations)
    result = _result(tagged, max_seq_length)
    if merged is not None:
        result = result._replace(merge=merged.stats)
    if not result.kept.isEmpty():
        write_training_bundle(result.kept, out, valid_frac, seed)
    return result


def validate_dataset(
    spark: SparkSession, path: str, *, max_seq_length: int = 1024, **read_options
) -> Built:
    """Check a file; ``report`` gains ``passed``: something kept and nothing skipped."""
    with _lines_named(spark, path):
        result = _result(_tagged(read_conversations(spark, path, **read_options)), max_seq_length)
    passed = (F.col("skipped") == 0) & (F.col("count") > 0)
    return result._replace(report=result.report.withColumn("passed", passed))


def search(
    queries: DataFrame,
    pairs: DataFrame,
    *,
    top_k: int = 6,
    prompts: bool = False,
) -> DataFrame:
    """Answer every ``query_id, text`` from question/answer pairs (``seq, user, assistant``).

    ``prompts=True`` gives the model prompts of the queries with hits instead of the
    plain context.
    """
    documents = stage(build_documents(pairs), "documents")  # read several times
    hits = search_documents(queries, documents, top_k)
    return _answers(queries, hits, documents, top_k, prompts)


def _answers(queries, hits, documents, top_k, prompts):
    found = attach_documents(hits, documents, small=few_hits(queries, top_k))
    contexts = make_context(found)
    return build_prompts(queries, contexts) if prompts else answer_queries(queries, contexts)


def search_file(
    spark: SparkSession, path: str, queries: DataFrame, *, multi_line: bool = True, **options
) -> DataFrame:
    """``search`` over a question/answer CSV."""
    pairs = stage(read_pairs(spark, path, multi_line=multi_line), "pairs")
    return search(queries, pairs, **options)


def save_index(pairs: DataFrame, path: str) -> None:
    """Build the knowledge documents of the pairs and store them with their index."""
    write_index(stage(build_documents(pairs), "documents"), path)


def search_saved(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    *,
    top_k: int = 6,
    prompts: bool = False,
) -> DataFrame:
    """``search`` in a stored index."""
    index, documents = read_index(spark, path)
    return _answers(queries, search_index(queries, index, top_k), documents, top_k, prompts)


def prepare_from_csv_or_jsonl(
    spark: SparkSession,
    source: str,
    out: str = "out",
    *,
    merge: bool = True,
    multi_line: bool = True,
) -> str:
    """A CSV is merged and built; any other file is used as it is.  Returns the path of
    the training file."""
    if PurePosixPath(source).suffix.lower() != ".csv":
        return source
    if merge:
        source = merge_csv(spark, source, f"{out.rstrip('/')}/merged.csv", multi_line=multi_line)
    built = build_dataset(spark, source, out, multi_line=multi_line)
    if built.kept.isEmpty():
        raise ValueError(f"{source}: no usable conversation")
    return f"{out.rstrip('/')}/train_sharegpt.jsonl"


def merge_csv(spark: SparkSession, source: str, target: str, *, multi_line: bool = True) -> str:
    """Merge the repeated questions of a CSV; the source path when there are none."""
    pairs = resolve_columns(read_csv_records(spark, source, multi_line=multi_line))
    if not {"user", "assistant"} <= set(pairs.columns):
        return source
    merged = merge_same_user_pairs(stage(pairs, "pairs"))
    if merged.stats.first()["merged_prompt_groups"] == 0:
        return source
    write_merged_csv(merged.rows, target)
    return target


def render_training_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(training text, what of it is learned) of a prepared file."""
    conversations = read_training_json(spark, path)
    return render_chat_text(conversations), response_mask_report(conversations)
