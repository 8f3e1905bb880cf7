"""The prefix trie of conversations, folded by time-forward processing.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it.  Every node tells how many members, children and leaves
it has and how many characters its subtree saves when shared turns are stored once.

1. Turns.  Texts stay where they are: a turn is the 120-bit hash of its role and text and
   the number of code points.  Turns are sorted by range over (conversation, turn) and
   numbered in place; a conversation that is cut by the ranges goes on with the count of
   its earlier pieces, so a conversation with a third of all turns is many tasks.
2. Rebuilding.  A conversation takes its first turns over from the first of its block of
   hundred, as the contract of ``op12`` says (``borrow``); general use leaves that out.
3. Nodes.  The name of a node is its depth and the running XOR (two words) of the hashes of
   (place, turn): running values of the pieces of a conversation put together.  Conversations
   with the same beginning give the same name; nodes are counted with map-side combination.
4. Subtree totals.  Nodes that at least one in ``HEAVY`` rows pass through are heavy; there
   are at most ``HEAVY`` of them and they are the top of the trie.  Below hang light
   subtrees, each with less than that share of the rows.  A shard is a hash bucket of light
   subtrees, its nodes sorted outside memory by reverse level order.  A task walks them:
   every node takes the messages of its children from a priority queue that spills, adds
   its own part, and sends the sum forward to its parent.  Messages of shard roots to heavy
   nodes are added up per task and then per node, and one last walk of the same kind folds
   the heavy top.
5. Member lists.  The ids that end in a node are sorted by range, joined in pieces by many
   tasks, and the pieces hashed in order; memory holds one piece.

Rows with a null conversation are left out.  A null turn number comes first; rows of the
same turn are ordered by the MD5 of role and text, so repeated rows are turns one after the
other.  Null roles and texts are empty.  A conversation may have no turns left after
rebuilding: it is a member of the root alone.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import read_table, stage

BLOCK = 100  # conversations that share a first one
BORROWED = 6  # up to one turn less is taken over
HEAVY = 8192  # a node is heavy if one in so many rows passes through it
QUEUE = 1 << 18  # messages a task holds in memory
RUNS = 16  # spilled runs before they are merged into one
PIECE = 1 << 15  # characters of joined ids in a row
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "depth bigint, kx bigint, ky bigint, px bigint, py bigint, conv_id bigint, n_convs bigint, chars bigint"


# Priority queue.


class SpillingQueue:
    """Messages by key, least first; beyond ``limit`` the later half goes to a sorted run on disk.

    Runs are anonymous files of the task; ``fold`` closes them all, and a lost task starts anew.
    """

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs = limit, [], []

    def push(self, key: tuple[int, int, int], values: tuple[int, int, int]) -> None:
        heapq.heappush(self.heap, (*key, *values))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        half = len(self.heap) // 2
        later, self.heap = self.heap[half:], self.heap[:half]
        if len(self.runs) >= RUNS:
            old = [iter([first]) if rest is None else _chain(first, rest) for first, rest, _ in self.runs]
            files = [f for *_, f in self.runs]
            self.runs = []
            self._write(heapq.merge(later, *old))
            for f in files:
                f.close()
        else:
            self._write(later)

    def _write(self, rows) -> None:
        file = tempfile.TemporaryFile()
        block = []
        for row in rows:
            block.append(row)
            if len(block) == 4096:
                file.write(np.array(block, np.int64).tobytes())
                block = []
        file.write(np.array(block, np.int64).tobytes())
        file.seek(0)
        read = _read(file)
        if (first := next(read, None)) is not None:
            self.runs.append((first, read, file))

    def take(self, key: tuple[int, int, int]) -> tuple[int, int, int]:
        """The summed values of all messages with that key, which must be the least of all."""
        a = b = c = 0
        while self.heap and self.heap[0][:3] == key:
            *_, x, y, z = heapq.heappop(self.heap)
            a, b, c = a + x, b + y, c + z
        for n in range(len(self.runs) - 1, -1, -1):
            first, rest, file = self.runs[n]
            while first is not None and first[:3] == key:
                a, b, c = a + first[3], b + first[4], c + first[5]
                first = next(rest, None)
            if first is None:
                file.close()
                del self.runs[n]
            else:
                self.runs[n] = (first, rest, file)
        return a, b, c


def _read(file) -> Iterator[tuple]:
    while data := file.read(4096 * 48):
        yield from map(tuple, np.frombuffer(data, np.int64).reshape(-1, 6).tolist())


def _chain(first, rest):
    yield first
    yield from rest


# Turns.


def turn_hashes(role: Column, text: Column) -> list[Column]:
    """md, dx, dy: the MD5 of a turn as text and in two words of 60 bits."""
    known = F.coalesce(role, F.lit(""))
    md = F.md5(F.concat(F.char_length(known).cast("string"), F.lit(":"), known, F.coalesce(text, F.lit(""))))
    return [md.alias("md"), *(F.conv(F.substring(md, at, 15), 16, 10).cast("bigint").alias(n) for at, n in ((1, "dx"), (16, "dy")))]


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation get their place in it, counted from 0 within the task."""
    last, seen = None, 0
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        at = np.arange(len(conv))
        starts = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
        place = at - np.repeat(starts, np.diff(np.append(starts, len(conv))))
        if last == conv[0]:
            first = int(starts[1]) if len(starts) > 1 else len(conv)
            place[:first] += seen
        last, seen = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, place, dx, dy, chars): ``place`` counts a conversation's turns from 0.

    ``segment`` numbers the ranges; a conversation lies in one of them or in some that follow
    each other.
    """
    slim = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *turn_hashes(F.col("role"), F.col("text")),
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("bigint").alias("chars"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "md"]
    laid = slim.repartitionByRange(*order, F.rand(5)).sortWithinPartitions(*order)  # rand cuts equal rows apart
    placed = laid.select("conv_id", "dx", "dy", "chars", F.spark_partition_id().cast("bigint").alias("segment")).mapInArrow(
        _number, "conv_id bigint, dx bigint, dy bigint, chars bigint, segment bigint, place bigint"
    )
    placed = stage(placed, "trie-turns")
    # One row per range: the conversation at its end, and how many turns of it the range holds.
    ends = placed.groupBy("segment").agg(F.max(F.struct("conv_id", "place")).alias("end"), F.min("conv_id").alias("first_conv"))
    ends = ends.select("segment", "first_conv", F.col("end.conv_id").alias("last_conv"), (F.col("end.place") + 1).alias("held"))
    earlier = ends.select(F.col("last_conv").alias("conv_id"), F.col("segment").alias("before"), F.col("held").alias("part"))
    moved = (
        ends.join(F.broadcast(earlier), (F.col("first_conv") == F.col("conv_id")) & (F.col("before") < F.col("segment")))
        .groupBy("conv_id", "segment")
        .agg(F.sum("part").alias("ahead"))
    )
    return placed.join(F.broadcast(moved), ["conv_id", "segment"], "left").select(
        "conv_id", "segment", (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("place"), "dx", "dy", "chars"
    )


# Nodes.


def _step(place: Column, dx: Column, dy: Column) -> list[Column]:
    """Two words for a turn at a place; the XOR of those of all turns so far names a node."""
    return [F.xxhash64(place, dx, dy), F.xxhash64(place, dy, dx)]


def _borrowed(heads: DataFrame, borrow: bool) -> DataFrame:
    """(conv_id, own, h, taken) of (conv_id, own, head): how many own turns are dropped, and the turns taken over."""
    if not borrow:
        return heads.select("conv_id", "own", F.lit(0).alias("h"), F.slice("head", 1, 0).alias("taken"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % BORROWED).cast("int")
    base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    mine = heads.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).withColumn("h", h)
    taken = F.when(F.col("base_head").isNull(), F.slice("head", 1, 0)).otherwise(F.slice("base_head", F.lit(1), F.col("h")))
    return mine.join(base, "base", "left").select("conv_id", "own", "h", taken.alias("taken"))


def prefix_rows(turns: DataFrame, borrow: bool) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, kx, ky, px, py, chars, last) of every turn of a rebuilt conversation, and (conv_id, length)."""
    placed = stage(numbered_turns(turns), "trie-places")
    turn = F.struct("place", "dx", "dy", "chars")
    heads = placed.groupBy("conv_id").agg(
        (F.max("place") + 1).alias("own"), F.array_sort(F.collect_list(F.when(F.col("place") < BORROWED - 1, turn))).alias("head")
    )
    plans = _borrowed(heads, borrow).withColumn("m", F.size("taken")).withColumn("length", F.col("m") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    for n, name in enumerate(("bx", "by")):
        words = F.transform("taken", lambda t: _step(t["place"], t["dx"], t["dy"])[n])
        plans = plans.withColumn(name, words)
    plans = stage(plans, "trie-plans")

    def folded(words: Column) -> Column:
        return F.aggregate(words, F.lit(0).cast("bigint"), lambda a, b: a.bitwiseXOR(b))

    # Turns taken over: at most five per conversation.
    upto = lambda n, k: folded(F.slice(n, F.lit(1), k))
    some = plans.filter("m > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("at"))
    first = some.select(
        "conv_id",
        F.col("at").cast("bigint").alias("depth"),
        upto("bx", F.col("at")).alias("kx"),
        upto("by", F.col("at")).alias("ky"),
        upto("bx", F.col("at") - 1).alias("px"),
        upto("by", F.col("at") - 1).alias("py"),
        F.element_at("taken", F.col("at"))["chars"].alias("chars"),
        (F.col("at") == F.col("length")).alias("last"),
    )
    # Own turns: running XOR within a range, on top of the ranges before and of the turns taken over.
    pieces = placed.groupBy("conv_id", "segment").agg(F.count(F.lit(1)).alias("n"))
    shift = plans.select("conv_id", "h", "m", "length", folded(F.col("bx")).alias("sx"), folded(F.col("by")).alias("sy"))
    own = (
        placed.join(pieces.select("conv_id", "segment").join(shift, "conv_id"), ["conv_id", "segment"])
        .filter("place >= h")
        .withColumn("at", F.col("m") + F.col("place") - F.col("h"))
    )
    wx, wy = _step(F.col("at"), F.col("dx"), F.col("dy"))
    own = own.withColumn("wx", wx).withColumn("wy", wy)
    # Only a conversation that goes on from one range to the next needs the earlier totals: a row per range.
    cut = pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_id")
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    totals = own.join(F.broadcast(cut), "conv_id").groupBy("conv_id", "segment").agg(F.bit_xor("wx").alias("tx"), F.bit_xor("wy").alias("ty"))
    totals = totals.select("conv_id", "segment", F.bit_xor("tx").over(before).alias("ex"), F.bit_xor("ty").over(before).alias("ey"))
    running = Window.partitionBy("conv_id", "segment").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    own = own.withColumn("kx", F.bit_xor("wx").over(running)).withColumn("ky", F.bit_xor("wy").over(running))
    own = own.join(F.broadcast(totals), ["conv_id", "segment"], "left")
    none = F.lit(0).cast("bigint")
    for k, s, e in (("kx", "sx", "ex"), ("ky", "sy", "ey")):
        own = own.withColumn(k, F.col(k).bitwiseXOR(F.col(s)).bitwiseXOR(F.coalesce(e, none)))
    own = own.select(
        "conv_id",
        (F.col("at") + 1).cast("bigint").alias("depth"),
        "kx",
        "ky",
        F.col("kx").bitwiseXOR(F.col("wx")).alias("px"),
        F.col("ky").bitwiseXOR(F.col("wy")).alias("py"),
        "chars",
        (F.col("at") + 1 == F.col("length")).alias("last"),
    )
    return stage(first.unionByName(own), "trie-rows"), plans.select("conv_id", "length")


def trie_nodes(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node (``NODE``); the root has depth 0 and the name (0, 0)."""
    below = rows.groupBy("depth", "kx", "ky").agg(
        F.min("px").alias("px"), F.min("py").alias("py"), F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars")
    )
    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("kx"), zero.alias("ky"), none.alias("px"), none.alias("py"), "conv_id", "n_convs", zero.alias("chars"))
    names = ["depth", "kx", "ky", "px", "py", "conv_id", "n_convs", "chars"]
    return stage(below.select(*names).unionByName(root), "trie-nodes")


# Subtree totals.

FOLDED = NODE + ", n_children bigint, n_leaves bigint, saved bigint, message boolean"


def _fold(limit: int):
    """Nodes in reverse level order, with what they got from outside, to nodes with totals.

    Sums for parents that are not in the shard go out as messages, one per parent and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FOLDED.split(", ")]
        types = [pa.int64()] * 11 + [pa.bool_()]
        queue = SpillingQueue(limit)
        outside: dict[tuple, list[int]] = defaultdict(lambda: [0, 0, 0])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            rows = []
            for depth, kx, ky, px, py, conv, n, chars, top, children, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                a, b, c = queue.take((-depth, kx, ky))
                children, leaves, saved = children + a, leaves + b, saved + c
                leaves = leaves or 1
                saved += (n - 1) * chars
                rows.append((depth, kx, ky, px, py, conv, n, chars, children, leaves, saved, False))
                if top:
                    if px is not None:
                        sums = outside[depth - 1, px, py]
                        sums[0] += 1
                        sums[1] += leaves
                        sums[2] += saved
                else:
                    queue.push((1 - depth, px, py), (1, leaves, saved))
            if rows:
                yield batch_of(rows)
        # Parents outside are heavy nodes, at most ``HEAVY``.
        if outside:
            yield batch_of([(*key, None, None, None, None, None, *sums, True) for key, sums in outside.items()])

    return run


FOLD_INPUT = ["depth", "kx", "ky", "px", "py", "conv_id", "n_convs", "chars", "top", "n_children", "n_leaves", "saved"]


def subtree_totals(nodes: DataFrame, rows: DataFrame, heavy_limit: int = HEAVY, queue: int = QUEUE) -> DataFrame:
    """The nodes with n_children, n_leaves and saved."""
    name = ["depth", "kx", "ky"]
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    is_heavy = (F.col("depth") == 0) | (F.col("n_convs") * heavy_limit >= total)
    heavy, light = nodes.filter(is_heavy), nodes.filter(~is_heavy)
    # The light subtree of a conversation hangs below its deepest heavy node: one row per conversation.
    up = F.broadcast(heavy.select(F.col("depth").alias("d"), F.col("kx").alias("x"), F.col("ky").alias("y")))
    mine = (F.col("depth") == F.col("d")) & (F.col("kx") == F.col("x")) & (F.col("ky") == F.col("y"))
    above = (F.col("depth") - 1 == F.col("d")) & (F.col("px") == F.col("x")) & (F.col("py") == F.col("y"))
    tops = rows.join(up, mine, "left_anti").join(up, above, "left_semi")
    tops = tops.select("conv_id", F.col("depth").alias("top_depth"), F.xxhash64("depth", "kx", "ky").alias("shard"))
    zero = F.lit(0).cast("bigint")
    given = [zero.alias(c) for c in ("n_children", "n_leaves", "saved")]
    order = [F.col("depth").desc(), "kx", "ky"]
    laid = (
        light.join(tops, "conv_id")
        .select(*nodes.columns, (F.col("depth") == F.col("top_depth")).alias("top"), *given, "shard")
        .repartition("shard")
        .sortWithinPartitions(*order)
        .select(*FOLD_INPUT)
    )
    folded = stage(laid.mapInArrow(_fold(queue), FOLDED), "trie-light")
    sums = folded.filter("message").groupBy(*name).agg(*[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved")])
    crown = heavy.join(sums, name, "left").withColumn("top", F.col("depth") == 0)
    crown = crown.select(*[F.coalesce(c, zero).alias(c) if c in ("n_children", "n_leaves", "saved") else F.col(c) for c in FOLD_INPUT])
    # At most ``heavy_limit`` nodes, and the root.
    crown = crown.coalesce(1).sortWithinPartitions(*order).mapInArrow(_fold(queue), FOLDED)
    every = folded.filter("NOT message").withColumn("heavy", F.lit(False)).unionByName(crown.filter("NOT message").withColumn("heavy", F.lit(True)))
    return stage(every.drop("message"), "trie-totals")


# Member lists.


def _pieces(size: int):
    """Ids sorted within nodes to pieces of the comma-joined list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["depth", "kx", "ky", "first", "piece"]
        types = [pa.int64()] * 4 + [pa.string()]
        here, ids, held = None, [], 0

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            rows = []
            for depth, kx, ky, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, kx, ky) != here or held >= size:
                    if ids:
                        rows.append((*here, ids[0], ",".join(map(str, ids))))
                    here, ids, held = (depth, kx, ky), [], 0
                ids.append(conv)
                held += 12
            if rows:
                yield batch_of(rows)
        if ids:
            yield batch_of([(*here, ids[0], ",".join(map(str, ids)))])

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    here, state, out = None, None, []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], names=["depth", "kx", "ky", "ends_sha256"])

    for batch in batches:
        for depth, kx, ky, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if (depth, kx, ky) != here:
                if here is not None:
                    out.append((*here, state.hexdigest()))
                here, state = (depth, kx, ky), hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        if out:
            yield batch_of(out)
            out = []
    if here is not None:
        yield batch_of([(*here, state.hexdigest())])


def end_digests(rows: DataFrame, lengths: DataFrame, size: int = PIECE) -> DataFrame:
    """(depth, kx, ky, ends_sha256) of every node in which conversations end."""
    zero = F.lit(0).cast("bigint")
    bare = lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("kx"), zero.alias("ky"), "conv_id")
    ends = rows.filter("last").select("depth", "kx", "ky", "conv_id").unionByName(bare)
    order = ["depth", "kx", "ky", "conv_id"]
    pieces = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pieces(size), "depth bigint, kx bigint, ky bigint, first bigint, piece string")
    laid = pieces.repartition("depth", "kx", "ky").sortWithinPartitions("depth", "kx", "ky", "first")
    return laid.select("depth", "kx", "ky", "piece").mapInArrow(_digests, "depth bigint, kx bigint, ky bigint, ends_sha256 string")


def conversation_trie(turns: DataFrame, borrow: bool = False, heavy: int = HEAVY, queue: int = QUEUE) -> DataFrame:
    """One row per node from (conv_id, turn, role, text) rows, as ``op12`` describes them."""
    rows, lengths = prefix_rows(turns, borrow)
    nodes = trie_nodes(rows, lengths)
    folded = subtree_totals(nodes, rows, heavy, queue)
    named = nodes.select(F.col("depth").alias("d"), F.col("kx").alias("x"), F.col("ky").alias("y"), F.col("conv_id").alias("parent_conv_id"))
    child = (F.col("depth") - 1 == F.col("d")) & (F.col("px") == F.col("x")) & (F.col("py") == F.col("y"))
    # Parents of many children are heavy, and there are few of those; the others shuffle.
    top = F.broadcast(folded.filter("heavy").select(F.col("depth").alias("d"), F.col("kx").alias("x"), F.col("ky").alias("y"), F.col("conv_id").alias("parent_conv_id")))
    below_top = folded.join(top, child, "left").drop("d", "x", "y")
    done = below_top.filter("parent_conv_id IS NOT NULL OR depth = 0")
    rest = below_top.filter("parent_conv_id IS NULL AND depth > 0").drop("parent_conv_id").join(named, child).drop("d", "x", "y")
    whole = done.unionByName(rest).join(end_digests(rows, lengths), ["depth", "kx", "ky"], "left")
    return whole.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"), borrow=True)


ORACLE = """
WITH RECURSIVE talks AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, md5(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM range(256) r(i))
), heads AS (
  SELECT conv_id, turns, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 6 AS h
  FROM talks, crc
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns, [])[1:a.h], a.turns[a.h + 1:]) AS turns
  FROM heads a LEFT JOIN talks b ON b.conv_id = a.base
), prefixes AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
  SELECT row_number() OVER () AS node, * FROM (
    SELECT depth, turns[1:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
      coalesce(string_agg(CASE WHEN len(turns) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ends
    FROM prefixes GROUP BY ALL)
), edges AS (
  SELECT c.node AS child, p.node AS parent, p.conv_id AS parent_conv_id
  FROM nodes c JOIN nodes p ON c.depth = p.depth + 1 AND p.path = c.path[1:p.depth]
), children AS (
  SELECT parent AS node, count(*) AS n_children FROM edges GROUP BY parent
), own AS (
  SELECT node, n_convs, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
    CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(path[depth].text) END AS saved
  FROM nodes LEFT JOIN children USING (node)
), within AS (
  SELECT node AS top, node FROM nodes
  UNION ALL
  SELECT within.top, edges.child FROM within JOIN edges ON edges.parent = within.node
), totals AS (
  SELECT top AS node, sum(leaf) AS n_leaves, sum(saved) AS saved FROM within JOIN own USING (node) GROUP BY top
)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM nodes LEFT JOIN edges ON child = node LEFT JOIN children USING (node) JOIN totals USING (node)
"""
