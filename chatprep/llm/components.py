"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatprep.llm.common import release, stage


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges to (node, component): the smallest node reachable; nodes without edges are absent.

    Every round is stored, so a lost executor repeats one round.  The rounds end when the
    edges are stars that no round changes any more.
    """
    current = stage(edges.filter(F.col("u") != F.col("v")).select("u", "v").distinct(), "edges")
    before = None
    while True:
        last, current = current, stage(_small_star(_large_star(current).distinct()).distinct(), "edges")
        release(last)
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 65536)).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    stars = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.unionByName(centres)
