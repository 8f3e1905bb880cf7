"""Mixing sources to target weights by Pareto order sampling.

Targets: every source asks for a share of all words by its weight; a source that would
pass ``most`` times its size stops there and the excess is shared again by weight.  With
sources ordered by size / weight, the level of the water is the largest of the levels
that each prefix of full sources gives, so no loop is needed.

Copies: within a source every document has an inclusion weight, a small whole number.  It
asks for level * weight copies, ``most`` at the most, and the level is the one at which the
source's words come to its target (found like that of the sources, over the few weights).
The whole part of what a document asks for is certain.  The fraction p that is left is its
inclusion probability in a Pareto order sample without replacement: with a uniform number
u it ranks by (u / (1 - u)) / (p / (1 - p)), and the lowest ranks are taken until their
words come as near to the rest of the target as whole documents allow.  So the sample is
unequal (documents of larger weight have larger p) and fixed in words, not random in size.

u comes from a hash of the id and the content, so reruns agree.  Ranks are cut into 4,096
slices of about equal counts by their distribution in the source, which the weights and
their counts give exactly; words are added up per slice and then within a slice, so a
source with a third of all rows is no single task.  Sources are numbered and summed by
ranges, so there may be as many of them as documents.

``mix_documents`` weighs a document by the number of digits of its word count.

Null sources are one source, the last.  Null and empty texts have size 0 and take 0 words.
Rows with equal ids and texts draw the same u and are ordered by size; an empty table gives
none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import WORD, fresh, group_key, read_table, seeded_hash, stage

SLICES = 4096
HASH_BITS = 52
MOST = 3


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """Adds, for each new name, the sum of a column over this row and all before it.

    Rows are laid out by ranges of the order; a range goes on from the totals of those
    before it, of which there is one row per range.
    """
    part = fresh(df, "part")
    laid = stage(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), "ranges")
    before = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = laid.groupBy(part).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    totals = totals.select(part, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in sums])
    here = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = laid.join(F.broadcast(totals), part)
    return joined.select(*df.columns, *[(F.sum(c).over(here) + F.col(f"{n}_before")).alias(n) for n, c in sums.items()])


def source_targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(strat, source, source_size, weight) to the same with ``target``."""
    order = [F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source")]
    summed = running_sums(sizes, order, {"sizes_to": "source_size", "weights_to": "weight"})
    whole = sizes.agg(F.sum("source_size").alias("all_sizes"), F.sum("weight").alias("all_weights"))
    level = (F.col("all_sizes") - most * (F.col("sizes_to") - F.col("source_size"))).cast("double") / (
        F.col("all_weights") - (F.col("weights_to") - F.col("weight"))
    ).cast("double")
    highest = summed.crossJoin(F.broadcast(whole)).agg(F.max(level).alias("level"))
    target = F.least(F.col("source_size").cast("double") * most, F.col("level") * F.col("weight"))
    return sizes.crossJoin(F.broadcast(highest)).withColumn("target", target).drop("level")


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, 3, 1, ... over sources by code point, null last."""
    one = sizes.withColumn("weight", F.lit(1).cast("bigint"))
    numbered = running_sums(one, [F.col("source").isNull(), F.col("source")], {"nth": "weight"})
    return numbered.withColumn("weight", (F.col("nth") - 1) % cycle + 1).drop("nth")


def inclusion(classes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """(strat, inclusion, size, docs) to strat, inclusion, certain, p, odds, rest and spread.

    ``certain`` copies of each document of the class and an inclusion probability ``p``;
    ``rest`` is what the certain copies leave of the target of the source, and ``spread``
    has the (share of documents, odds) of all its classes that are sampled.  A source has as
    many rows as there are different weights.
    """
    joined = classes.join(targets, "strat")
    full = Window.partitionBy("strat").orderBy(F.col("inclusion").desc()).rowsBetween(Window.unboundedPreceding, -1)
    others = Window.partitionBy("strat").orderBy(F.col("inclusion").desc()).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy("strat")
    left = F.col("target") - most * F.coalesce(F.sum("size").over(full), F.lit(0)).cast("double")
    asked = F.sum(F.col("size") * F.col("inclusion")).over(others).cast("double")
    joined = joined.withColumn("level", F.when(asked > 0, left / asked)).withColumn("level", F.coalesce(F.max("level").over(whole), F.lit(0.0)))
    joined = joined.withColumn("wanted", F.least(F.lit(float(most)), F.col("level") * F.col("inclusion")))
    joined = joined.withColumn("certain", F.floor("wanted").cast("bigint"))
    joined = joined.withColumn("p", F.col("wanted") - F.col("certain"))
    joined = joined.withColumn("odds", F.when(F.col("p") > 0, F.col("p") / (1 - F.col("p"))))
    docs = F.sum(F.when(F.col("odds").isNotNull(), F.col("docs"))).over(whole)
    spread = F.when(F.col("odds").isNotNull(), F.struct((F.col("docs") / docs).alias("share"), "odds"))
    return joined.select(
        "strat",
        "inclusion",
        "source_size",
        "target",
        "certain",
        "p",
        "odds",
        (F.col("target") - F.sum(F.col("certain") * F.col("size")).over(whole).cast("double")).alias("rest"),
        F.collect_list(spread).over(whole).alias("spread"),
    )


def take_copies(
    rows: DataFrame, ids: list[str], seed: int = 23, most: int = MOST, weigh=cyclic_weights, inclusion_weight: Column | None = None
) -> DataFrame:
    """Rows with ``source`` and ``size`` to the same with source_size, target, copies, and the certain copies and p behind them.

    ``ids`` fix the random order; ``inclusion_weight`` is a whole number from 1 on with few
    values, 1 for all by default.
    """
    names = ("strat", "draw", "slice", "rank", "inclusion", "below", "ahead")
    strat, draw, slice_, rank, weight, below, ahead = (fresh(rows, n) for n in names)
    given = F.lit(1) if inclusion_weight is None else inclusion_weight
    keyed = stage(
        rows.withColumn(strat, group_key(F.col("source"))).withColumn(draw, seeded_hash(seed, *map(F.col, ids))).withColumn(weight, given.cast("bigint")),
        "mix-rows",
    )
    classes = keyed.groupBy(F.col(strat).alias("strat"), "source", F.col(weight).alias("inclusion")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")
    )
    classes = stage(classes, "mix-classes")
    sizes = classes.groupBy("strat", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(weigh(stage(sizes, "mix-sources")), most).select("strat", "source_size", "target")
    plan = stage(inclusion(classes.drop("source"), targets, most), "mix-plan")
    plan = plan.withColumnsRenamed({"strat": strat, "inclusion": weight})
    u = (F.col(draw).cast("double") + 0.5) / float(1 << HASH_BITS)
    ranked = keyed.join(plan, [strat, weight]).withColumn(rank, (u / (1 - u)) / F.col("odds"))
    # The share of the source's sampled documents that rank no higher is even whatever the weights.
    share = F.aggregate("spread", F.lit(0.0), lambda a, k: a + k["share"] * (1 - 1 / (1 + F.col(rank) * k["odds"])))
    ranked = ranked.withColumn(slice_, F.floor(share * SLICES).cast("int")).drop("spread")
    ranked = stage(ranked, "mix-ranks")
    slices = ranked.filter(F.col(rank).isNotNull()).groupBy(strat, slice_).agg(F.sum("size").alias(below))
    running = Window.partitionBy(strat).orderBy(slice_).rowsBetween(Window.unboundedPreceding, 0)
    slices = slices.select(strat, slice_, (F.sum(below).over(running) - F.col(below)).alias(below))
    order = Window.partitionBy(strat, slice_).orderBy(rank, draw, *ids, "size").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col(below) + F.col(ahead) - F.col("size") / 2
    sampled = ranked.filter(F.col(rank).isNotNull()).join(slices, [strat, slice_]).withColumn(ahead, F.sum("size").over(order))
    sampled = sampled.withColumn("copies", F.col("certain") + F.when(middle <= F.col("rest"), 1).otherwise(0))
    fixed = ranked.filter(F.col(rank).isNull()).withColumn("copies", F.col("certain"))
    columns = [*[f"`{c}`" for c in rows.columns], "source_size", "target", "copies", "certain", "p"]
    return sampled.select(*columns).unionByName(fixed.select(*columns)).withColumn("copies", F.col("copies").cast("int"))


def mix_documents(docs: DataFrame, seed: int = 23) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, certain and p of every document; no text moves."""
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint")
    slim = docs.select("doc_id", "source", size.alias("size"), F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("content"))
    return take_copies(slim, ["doc_id", "content"], seed, inclusion_weight=digits(F.col("size"))).drop("content")


def digits(size: Column) -> Column:
    """1 for sizes below 10, 2 below 100 and so on."""
    return F.length(size.cast("string"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_documents(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with the columns of ``docs``.

    The mix is decided on ids, hashes of the texts and sizes; the copies then join the
    documents.  Rows with the same id, text and source are copies of one document of their
    summed size, so that all of them are taken as often.  Different texts with one id, or
    without one, are documents of their own, each in its source.
    """
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("bigint")
    key, number = fresh(docs, "mix_key"), fresh(docs, "mix_copies")
    one = F.struct(group_key(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("text"), group_key(F.col("source")).alias("source"))
    slim = docs.select(one.alias("doc_id"), "source", size.alias("size"))
    slim = slim.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    copies = take_copies(slim, ["doc_id"], inclusion_weight=digits(F.col("size"))).select(F.col("doc_id").alias(key), F.col("copies").alias(number))
    taken = docs.withColumn(key, one).join(copies.filter(F.col(number) > 0), key)
    return taken.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(number))).alias(number)).drop(number)


ORACLE = r"""
WITH rows AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS strat,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS content
  FROM documents
), keyed AS (
  SELECT *, CAST('0x' || substr(md5('23:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || content), 1, 13) AS BIGINT) AS draw,
    length(CAST(size AS VARCHAR)) AS inclusion
  FROM rows
), sizes AS (
  SELECT strat, source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight
  FROM rows GROUP BY strat, source
), levels AS (
  SELECT *, CAST(sum(source_size) OVER () - 3 * (sum(source_size) OVER w - source_size) AS DOUBLE)
    / CAST(sum(weight) OVER () - (sum(weight) OVER w - weight) AS DOUBLE) AS level
  FROM sizes
  WINDOW w AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), targets AS (
  SELECT strat, source_size, least(CAST(source_size AS DOUBLE) * 3, max(level) OVER () * weight) AS target FROM levels
), classes AS (
  SELECT strat, inclusion, CAST(sum(size) AS BIGINT) AS size FROM keyed GROUP BY strat, inclusion
), asked AS (
  SELECT *, target - 3 * CAST(coalesce(sum(size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS left_over,
    CAST(sum(size * inclusion) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS asked
  FROM classes JOIN targets USING (strat)
  WINDOW w AS (PARTITION BY strat ORDER BY inclusion DESC)
), wanted AS (
  SELECT *, least(3.0::DOUBLE, coalesce(max(CASE WHEN asked > 0 THEN left_over / asked END) OVER (PARTITION BY strat), 0) * inclusion) AS wanted FROM asked
), plan AS (
  SELECT *, floor(wanted) AS certain, wanted - floor(wanted) AS p,
    target - CAST(sum(floor(wanted) * size) OVER (PARTITION BY strat) AS DOUBLE) AS rest
  FROM wanted
), ranked AS (
  SELECT k.*, source_size, target, certain, rest, p,
    CASE WHEN p > 0 THEN ((draw + 0.5::DOUBLE) / 4503599627370496 / (1 - (draw + 0.5::DOUBLE) / 4503599627370496)) / (p / (1 - p)) END AS rank
  FROM keyed k JOIN plan USING (strat, inclusion)
), summed AS (
  SELECT *, sum(size) OVER (PARTITION BY strat, p > 0 ORDER BY rank, draw, doc_id, content, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ahead
  FROM ranked
)
SELECT doc_id, size, source_size, target,
  CAST(size * (certain + CASE WHEN p > 0 AND ahead - size / 2.0 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM summed
"""
