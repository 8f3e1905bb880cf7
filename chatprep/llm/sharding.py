"""Sharding by proportional stratified interleaving.

Rows of each source are put in a seeded random order.  Row r of n in its source has the
fractional rank (r - u) / n with a random start u of its own for every source; sorting all
rows by it interleaves the sources in proportion, and cutting the sorted sequence into
equal pieces gives shards that each match the mixture and whose row counts are at most one
apart.  The starts spread sources of one or few rows evenly over the shards, so a long
tail of them is part of the mixture like a large source.

Nothing is sorted in one task: both rankings count rows per slice of an evenly spread key
(4,096 slices), add the counts up, and number rows only within a slice.  A source that
holds a third of all rows is 4,096 slices like any other, and so is a crowd of rows that
share an id or have none, as the order is drawn from all of ``ids``.

Null sources are a source of their own.  Null and empty texts are rows like others.  Rows
with equal ids are ordered by size and checksum; rows equal in these too are alike.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import fresh, group_key, read_table, seeded_hash, stage

SLICE_BITS = 12
HASH_BITS = 52


def start_of(seed: int, strat: Column) -> Column:
    """A number above 0 and below 1 for every source."""
    return (seeded_hash(seed, strat).cast("double") + 0.5) / float(1 << HASH_BITS)


def interleaved(rows: DataFrame, source: Column, ids: list[Column], shards: int, seed: int = 17) -> DataFrame:
    """The rows with ``shard`` and ``slot`` (position in the shard, from 0, no gaps).

    Rows are shuffled as they are: drop long texts before, join them again afterwards.
    ``ids`` fix the random order; rows equal in all of them are interchangeable.
    """
    names = [fresh(rows, n) for n in ("strat", "draw", "slice", "place", "below", "total", "rank", "cut", "start")]
    strat, draw, slice_, place, below, total, rank, cut, start = names
    keyed = stage(
        rows.withColumn(strat, group_key(source))
        .withColumn(draw, seeded_hash(seed, *ids))
        .withColumn(slice_, F.shiftright(F.col(draw), HASH_BITS - SLICE_BITS).cast("int")),
        "shard-rows",
    )
    counts = keyed.groupBy(strat, slice_).agg(F.count(F.lit(1)).alias(place))
    per_source = Window.partitionBy(strat)
    counts = counts.select(
        strat,
        slice_,
        (F.sum(place).over(per_source.orderBy(slice_).rowsBetween(Window.unboundedPreceding, 0)) - F.col(place)).alias(below),
        F.sum(place).over(per_source).alias(total),
    )
    within = F.row_number().over(Window.partitionBy(strat, slice_).orderBy(draw, *ids))
    ranked = (
        keyed.withColumn(place, within)
        .join(counts, [strat, slice_])
        .withColumn(rank, ((F.col(below) + F.col(place)).cast("double") - start_of(seed, F.col(strat))) / F.col(total).cast("double"))
        .withColumn(cut, F.least(F.floor(F.col(rank) * (1 << SLICE_BITS)), F.lit((1 << SLICE_BITS) - 1)).cast("int"))
        .drop(place, below, total, slice_, draw)
    )
    ranked = stage(ranked, "shard-ranks")
    # At most 4,096 rows of counts: summed in one small task and broadcast.
    everything = Window.partitionBy(F.lit(0))
    starts = (
        ranked.groupBy(cut)
        .agg(F.count(F.lit(1)).alias(place))
        .select(
            cut,
            (F.sum(place).over(everything.orderBy(cut).rowsBetween(Window.unboundedPreceding, 0)) - F.col(place)).alias(start),
            F.sum(place).over(everything).alias(total),
        )
    )
    position = (F.col(start) + F.row_number().over(Window.partitionBy(cut).orderBy(rank, strat)) - 1).cast("bigint")
    placed = ranked.join(F.broadcast(starts), cut).withColumn(place, position)
    shard = F.expr(f"({place} * {shards}) div {total}")
    # The first position of shard k is ceil(k * total / shards).
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col(place) - first).cast("bigint"))
        .drop(cut, start, total, place, rank, strat)
    )


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 17) -> DataFrame:
    """doc_id, source, size, text_crc32, shard, slot: one row per document, text left behind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        "doc_id",
        "source",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return interleaved(slim, F.col("source"), [F.col("doc_id"), F.col("size"), F.col("text_crc32")], shards, seed)


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order.  ``placed`` has ``shard`` and ``slot``."""
    (
        placed.repartition("shard", F.expr("slot div 1000000"))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(read_table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def shard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of ``docs``; rows that the mix repeats get several."""
    return shard_documents(docs).select("doc_id", "source", "size", "shard", "slot")


ORACLE = """
WITH bytes AS (
  SELECT rn, doc_id, source, hex(encode(coalesce(text, ''))) AS h
  FROM (SELECT *, row_number() OVER () AS rn FROM documents)
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(i))
), slim AS (
  SELECT doc_id, source, CAST(length(h) // 2 + 8 AS BIGINT) AS size,
    xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(range(length(h) // 2), lambda k: CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT))),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc
), drawn AS (
  SELECT *, CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || text_crc32), 1, 13) AS BIGINT) AS draw,
    CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS strat
  FROM slim
), ranked AS (
  SELECT *, (CAST(row_number() OVER (PARTITION BY strat ORDER BY draw, doc_id, size, text_crc32) AS DOUBLE)
      - (CAST(CAST('0x' || substr(md5('17:' || strat), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496)
    / CAST(count(*) OVER (PARTITION BY strat) AS DOUBLE) AS f
  FROM drawn
), placed AS (
  SELECT *, row_number() OVER (ORDER BY f, strat) - 1 AS place, count(*) OVER () AS total FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(place * 24 // total AS INTEGER) AS shard,
  CAST(place - (place * 24 // total * total + 23) // 24 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""
