"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text is the multiset of its word shingles.  A shingle hashes to 64 bits (XXH64, seed 42),
and a bit of the fingerprint is set where more than half of the hashes have it set.  Two
fingerprints link when they differ in at most two bits.

1. Copies.  Equal fingerprints are one node from here on: a group of copies costs one row
   per task, not one per copy or pair.
2. Balls.  Every node emits all variants within half the radius, that is itself and the 64
   fingerprints one bit away.  Two nodes within two bits share a variant, and two nodes
   that share a variant are within two bits, so nothing is missed.
3. Collisions.  Rows meet by variant.  A variant has at most 65 nodes around it, whatever
   the data, and each links with the least of them; the repeated pairs that several
   variants report are dropped and the rest is verified by counting differing bits.

Links that only the least node of a variant does not report are implied: all nodes of a
variant link with that one, so they are in its component.

Ids are integers.  Null and empty texts have the fingerprint zero, and link like others.
Rows with a null id take part; a component without any id has a null name.  Repeated rows
and rows that share an id are rows of their own.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import read_table, stage
from chatprep.llm.components import connected_components

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
PIECE = 1 << 16  # shingles whose bits are counted at a time


def shingles(text: bytes, width: int) -> Iterator[bytes]:
    """Word shingles of the ASCII-lower-cased text, joined by blanks; shorter texts give one."""
    words = text.lower().split()
    if not words:
        return
    line = b" ".join(words)
    if len(words) <= width:
        yield line
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-width] + 1))
    for s, e in zip(starts.tolist(), ends[width - 1 :].tolist()):
        yield line[s:e]


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number; a text is walked in pieces, however long."""
    ones, count, held = np.zeros(BITS, np.int64), 0, []

    def add():
        hashes = np.array(held, np.uint64)
        return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)

    for shingle in shingles(text or b"", width):
        held.append(xxhash.xxh64_intdigest(shingle, SEED))
        if len(held) == PIECE:
            ones, count, held = ones + add(), count + PIECE, []
    if held:
        ones, count = ones + add(), count + len(held)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc", "print"])

    return run


def fingerprints(docs: DataFrame, doc: Column, text: Column, width: int = SHINGLE) -> DataFrame:
    """(doc, print) of every row; the fingerprint as a signed number."""
    return docs.select(doc.cast("bigint").alias("doc"), text.cast("binary").alias("text")).mapInArrow(
        _fingerprints(width), "doc bigint, print bigint"
    )


def variants(print_: Column) -> Column:
    """The fingerprint and all that differ from it in one bit: the ball of half the radius."""
    flips = [1 << b for b in range(BITS - 1)] + [-(1 << (BITS - 1))]
    return F.array(print_, *[print_.bitwiseXOR(F.lit(flip).cast("bigint")) for flip in flips])


def near_prints(prints: DataFrame) -> DataFrame:
    """(u, v) of distinct fingerprints: each with the least one of every variant they share."""
    balls = prints.select("print", F.explode(variants(F.col("print"))).alias("variant"))
    least = F.min("print").over(Window.partitionBy("variant"))
    met = balls.select(least.alias("u"), F.col("print").alias("v")).filter("u < v").distinct()
    return met.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS)


def simhash_classes(prints: DataFrame) -> DataFrame:
    """(doc, print) rows to (print, copies, component): the least id reachable from a fingerprint."""
    nodes = stage(prints.groupBy("print").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("copies")), "prints")
    linked = connected_components(near_prints(nodes.select("print")))
    named = stage(nodes.join(linked, nodes["print"] == linked["node"], "left").drop("node"), "linked-prints")
    alone, met = named.filter("component IS NULL"), named.filter("component IS NOT NULL")
    names = met.groupBy("component").agg(F.min("least").alias("name"))
    both = met.join(names, "component").select("print", "copies", F.col("name").alias("component"))
    return both.unionByName(alone.select("print", "copies", F.col("least").alias("component")))


def simhash_join(docs: DataFrame, doc: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """doc, print, copies (rows with that fingerprint) and component of every row."""
    prints = stage(fingerprints(docs, F.col(doc), F.col(text), width), "fingerprints")
    return prints.join(simhash_classes(prints), "print").select("doc", "print", "copies", "component")


def op11_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = simhash_join(read_table(spark, sf_dir, "documents"))
    return joined.select(
        F.col("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
