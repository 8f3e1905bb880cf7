"""Term statistics of documents and queries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chatprep.functions.terms import (
    GRAM_LENGTHS,
    PIECE,
    code_points,
    from_code_points,
    point_count,
    point_slice,
    words,
)
from chatprep.functions.text import drop_whitespace, fold
from chatprep.operators.counting import Asked, counted_terms, term_blocks, term_frequencies
from chatprep.operators.grid import packed_schema


# Document text, in characters, whose terms one task expands and counts.
TASK_CHARS = 1 << 24


class Index(NamedTuple):
    """``postings``: doc_seq, term, tf.  ``term_stats``: term, df, idf.

    ``blocks`` are the same postings in lists, as ``block_postings`` has them, of documents
    in ``parts`` partitions.  ``frequencies`` are theirs in an index that is not stored, as
    ``task_frequencies`` has them.  Stored tables also have ``bucket``, the partition a term
    is in; there are ``buckets``.
    """

    postings: DataFrame
    term_stats: DataFrame
    buckets: int = 0
    blocks: DataFrame | None = None
    parts: int = 0
    frequencies: DataFrame | None = None

    def of_terms(self, terms: DataFrame) -> Index:
        """The partitions of both tables in which these terms are, known before any is read."""
        if not self.buckets:
            return self
        # At most as many numbers as there are partitions.
        found = terms.select(term_bucket(F.col("term"), self.buckets).alias("bucket")).distinct().collect()
        here = F.col("bucket").isin(sorted(r["bucket"] for r in found))
        blocks = None if self.blocks is None else self.blocks.filter(here)
        return Index(self.postings.filter(here), self.term_stats.filter(here), blocks=blocks, parts=self.parts)


def term_bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _coded_terms(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One ``<keys>, _term`` row per word and n-gram, the term as code points.

    Every row of the last step is one slice of the text or one of its words, so no
    list of terms is ever built.  A long text is walked in pieces; n-grams across
    their ends are kept.
    """
    texts = df.select(
        *keys,
        fold(F.col(text)).alias("_text"),
    ).withColumn("_own", drop_whitespace(F.col("_text")))
    coded = texts.select(
        *keys,
        words("_text").alias("_words"),
        F.length("_own").alias("_length"),
        code_points(F.col("_own")).alias("_points"),
    )
    # Blank texts keep one empty piece: a filter on the length would be moved down to the
    # scan and clean every text there a second time.
    last_piece = F.floor(F.greatest(F.col("_length") - 1, F.lit(0)) / PIECE).cast("int")
    pieces = coded.select(
        "*", F.explode(F.sequence(F.lit(0), last_piece)).alias("_piece")
    ).withColumn("_start", F.col("_piece") * PIECE)
    own = F.least(F.lit(PIECE), F.col("_length") - F.col("_start"))
    left = point_count("_points") - F.col("_start")
    # How many n-grams of each length start in the piece; the words go with the first.
    counted = pieces.withColumns(
        {
            f"_count{n}": F.greatest(F.least(own, left - (n - 1)), F.lit(0)) for n in GRAM_LENGTHS
        }
        | {"_count_words": F.when(F.col("_piece") == 0, F.size("_words")).otherwise(F.lit(0))}
    )
    total = sum((F.col(f"_count{n}") for n in GRAM_LENGTHS), F.col("_count_words"))
    numbered = (
        counted.withColumn("_total", total)
        .filter(F.col("_total") > 0)
        .select("*", F.explode(F.sequence(F.lit(0), F.col("_total") - 1)).alias("_i"))
    )
    i, chain = F.col("_i"), F
    for n in GRAM_LENGTHS:
        count = F.col(f"_count{n}")
        chain = chain.when(i < count, point_slice(F.col("_points"), F.col("_start") + i, n))
        i = i - count
    return numbered.select(*keys, chain.otherwise(code_points(F.get("_words", i))).alias("_term"))


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def tokenize_terms(df: DataFrame, key: str | list[str], text: str) -> DataFrame:
    """One ``<key>, term`` row per word and per 2- and 3-character n-gram of the text.

    N-grams run over the text without white space.
    """
    keys = _keys(key)
    coded = _coded_terms(df, keys, text)
    return coded.select(*keys, from_code_points("_term").alias("term"))


def _counted(df: DataFrame, keys: list[str], text: str, *, merge: bool) -> DataFrame:
    """Terms counted per row, or with ``merge`` per run of rows with the same (single) key."""
    texts = df.select(*keys, fold(F.col(text)).alias("_text"))
    key_types = [f for f in texts.schema.fields if f.name in keys]
    schema = T.StructType([*key_types, T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return texts.mapInArrow(counted_terms(keys, PIECE, merge), schema)


def term_counts(df: DataFrame, key: str | list[str], text: str) -> DataFrame:
    """``<key>, term, tf``: the bag of terms of every row's text."""
    keys = _keys(key)
    counts = _counted(df, keys, text, merge=False)
    return counts.groupBy(*keys, "term").agg(F.sum("tf").alias("tf"))


def document_frequency(postings: DataFrame, term: str = "term") -> DataFrame:
    """``term, df``: in how many documents a term stands, of postings, blocks or counts by task."""
    if "df" in postings.columns:
        return postings.groupBy(term).agg(F.sum("df").alias("df"))
    # One per posting.
    return postings.groupBy(term).agg(F.sum(F.least("tf", F.lit(1))).alias("df"))


def idf_table(frequencies: DataFrame, documents: DataFrame) -> DataFrame:
    """Add ``idf = ln((N + 1) / (df + 0.5)) + 1``; N counts all documents."""
    n = F.broadcast(documents.agg(F.count(F.lit(1)).alias("_n")))  # one row
    idf = F.log((F.col("_n") + 1) / (F.col("df") + F.lit(0.5))) + F.lit(1.0)
    return frequencies.crossJoin(n).select("term", "df", idf.alias("idf"))


def spread_documents(
    documents: DataFrame, task_chars: int = TASK_CHARS
) -> tuple[DataFrame, int]:
    """Texts placed by ``doc_seq`` in as many partitions as their length asks for.

    Terms outnumber characters two to one, so partition counts chosen from the bytes
    of the texts (as adaptive execution would) leave far too few tasks.  Placed like
    this, terms are counted per document without a shuffle of terms.
    """
    texts = documents.select("doc_seq", "text").filter(F.col("text").isNotNull())
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    at_least = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(at_least, -(-chars // task_chars))
    return texts.repartition(tasks, "doc_seq").sortWithinPartitions("doc_seq"), tasks


def spread_postings(spread: DataFrame) -> DataFrame:
    """``doc_seq, term, tf`` of texts laid out by ``spread_documents``."""
    return _counted(spread, ["doc_seq"], "text", merge=True)


def asked_postings(spread: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """``doc_seq, tid, tf`` with lists of the numbers of these terms: at least a row per document that has any."""
    texts = spread.select("doc_seq", fold(F.col("text")).alias("_text"))
    return texts.mapInArrow(counted_terms(["doc_seq"], PIECE, True, Asked(numbers)), packed_schema(texts))


def block_postings(spread: DataFrame) -> DataFrame:
    """``term, part, block, df, docs, tfs`` of texts laid out by ``spread_documents``.

    Per term and block of documents a list of those that have the term, in order, and how
    often each has it.  A document is in one block of one part, however many terms it has.
    """
    # Not the number of the task: that counts on where tables are put together in a union.
    part = F.spark_partition_id().cast("long").alias("part")
    texts = spread.select("doc_seq", fold(F.col("text")).alias("_text"), part)
    numbers = [T.StructField(name, T.LongType()) for name in ("part", "block", "df")]
    docs = T.StructField("docs", T.ArrayType(texts.schema["doc_seq"].dataType))
    schema = T.StructType([T.StructField("term", T.StringType()), *numbers, docs, T.StructField("tfs", T.ArrayType(T.LongType()))])
    return texts.mapInArrow(term_blocks("doc_seq", PIECE), schema)


def task_frequencies(spread: DataFrame) -> DataFrame:
    """``term, df`` of texts laid out by ``spread_documents``: a row per term and task.

    A document is in one task, so the rows of a term add up to its document frequency.
    """
    texts = spread.select("doc_seq", fold(F.col("text")).alias("_text"))
    schema = T.StructType([T.StructField("term", T.StringType()), T.StructField("df", T.LongType())])
    return texts.mapInArrow(term_frequencies("doc_seq", PIECE), schema)


def flat_postings(blocks: DataFrame) -> DataFrame:
    """``doc_seq, term, tf`` of blocks, and their bucket where they are stored."""
    others = [c for c in ("bucket",) if c in blocks.columns]
    each = blocks.select("term", *others, F.explode(F.arrays_zip("docs", "tfs")).alias("_p"))
    return each.select(F.col("_p.docs").alias("doc_seq"), "term", F.col("_p.tfs").alias("tf"), *others)


def build_index(documents: DataFrame, asked: DataFrame | None = None) -> Index:
    """Index of ``doc_seq, text``.  All of it comes from the texts: store the blocks first
    (as ``write_index`` does) where several tables are to be written.

    With ``asked`` (``term``) only those terms have statistics: what the counting tasks give
    of others is not shuffled, where Spark broadcasts the terms.
    """
    spread, parts = spread_documents(documents)
    frequencies = task_frequencies(spread)
    held = frequencies if asked is None else frequencies.join(asked, "term", "left_semi")
    stats = idf_table(document_frequency(held), documents)
    return Index(spread_postings(spread), stats, blocks=block_postings(spread), parts=parts, frequencies=frequencies)


def block_stats(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    return idf_table(document_frequency(blocks), documents)
