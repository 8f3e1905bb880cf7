"""Writers: JSON Lines, CSV and the saved index.

Spark writes a folder of part files under the given name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chatprep.operators.index import Index, block_postings, block_stats, flat_postings, spread_documents, term_bucket
from chatprep.operators.normalize import messages_to_sharegpt
from chatprep.operators.split import split_train_valid
from chatprep.staging import stage

BUCKET_ROWS = 1 << 16  # postings of a partition of a stored index
MOST_BUCKETS = 4096


def in_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in key order across and within partitions, so part files read in order."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def with_place(df: DataFrame, *keys: str) -> DataFrame:
    """Add ``place``: how many rows come before in key order.

    Rows are numbered within the ranges of the order, which go on from the counts of the
    ranges before: one row per range.  Keys must tell all rows apart.
    """
    laid = stage(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = laid.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select("_range", (F.sum("_rows").over(before) - F.col("_rows")).alias("_before"))
    here = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    numbered = laid.join(F.broadcast(counts), "_range").withColumn("place", (F.col("_before") + here - 1).cast("bigint"))
    return numbered.select(*df.columns, "place")


def write_jsonl(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """One JSON object per line; text outside ASCII is written as it is."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_training_bundle(
    kept: DataFrame, out_dir: str, valid_frac: float = 0.1, seed: int = 3407
) -> None:
    """All kept conversations as ShareGPT rows in input order; train and validation sets
    as messages in shuffled order.  Reads ``kept`` several times: give a stored table."""
    base = out_dir.rstrip("/")
    sharegpt = in_order(messages_to_sharegpt(kept), "seq")
    write_jsonl(sharegpt.select("conversations"), f"{base}/train_sharegpt.jsonl")
    split = split_train_valid(kept.select("seq", "messages"), valid_frac, seed)
    for side, name in [(split.train, "train"), (split.valid, "valid")]:
        write_jsonl(in_order(side, "_shuffle", "seq").select("messages"), f"{base}/{name}.jsonl")


def write_merged_csv(pairs: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    columns = [c for c in ("user", "assistant", "system") if c in pairs.columns]
    in_order(pairs, "seq").select(*columns).write.mode(mode).csv(
        path, header=True, quote='"', escape='"', quoteAll=True, encoding="UTF-8"
    )


def write_index(documents: DataFrame, path: str, *, mode: str = "overwrite", bucket_rows: int = BUCKET_ROWS) -> None:
    """Index documents and store postings, term statistics and documents.

    Terms are counted once: blocks of postings are stored as they come, and statistics and
    the final order are made from the stored table.  Both tables are partitioned by the hash
    of the term, into about one partition per ``bucket_rows`` postings, so a search reads the
    partitions of its terms.  Blocks are in order of term, then part and number, within and
    across the files of a partition, so a term that is in every document is spread over
    several files.
    """
    base = path.rstrip("/")
    documents.write.mode(mode).parquet(f"{base}/documents")
    spread, parts = spread_documents(documents)
    blocks = stage(block_postings(spread), "postings")
    count = blocks.agg(F.sum("df")).first()[0] or 0
    buckets = min(max(-(-count // bucket_rows), 1), MOST_BUCKETS)
    bucket = term_bucket(F.col("term"), buckets)
    for table, name, order in [
        (blocks, "postings", ["term", "part", "block"]),
        (block_stats(blocks, documents), "term_stats", ["term"]),
    ]:
        laid = in_order(table.withColumn("bucket", bucket), "bucket", *order)
        laid.write.mode(mode).partitionBy("bucket").parquet(f"{base}/{name}")
    layout = documents.sparkSession.range(1).select(F.lit(buckets).alias("buckets"), F.lit(parts).alias("parts"))
    layout.write.mode(mode).parquet(f"{base}/layout")


def read_index(spark: SparkSession, path: str) -> tuple[Index, DataFrame]:
    base = path.rstrip("/")
    layout = spark.read.parquet(f"{base}/layout").first()
    tables = []
    for name in ("postings", "term_stats"):
        found = spark.read.parquet(f"{base}/{name}")  # a table without rows has no partitions
        tables.append(found if "bucket" in found.columns else found.withColumn("bucket", F.lit(0)))
    blocks, stats = tables
    index = Index(flat_postings(blocks), stats, layout["buckets"], blocks, layout["parts"])
    return index, spark.read.parquet(f"{base}/documents")
