"""N-gram Jaccard join in a metric space.

A document is the set of its word n-grams; two documents link when their Jaccard
similarity is at least ``num / den``, that is, when they are within ``eps`` of each other
in the Jaccard metric.  Components are the classes of linked documents.

1. Shells and coordinates.  Distances to the empty set split documents into size shells;
   a document near the upper rim of its shell is copied into the next (a linked document
   is at most ``den / num`` times as large).  In a shell linked sets differ in at most D
   n-grams, so cutting the n-gram space into D + 1 slices leaves one slice without any
   difference: a region is all documents of a shell that agree on a slice.  Random
   documents share no n-gram, are at distance 1 from every pivot, and would be copied into
   every Voronoi cell; this step keeps them apart, and it loses no link.  There are
   ``SPARE`` times D + 1 slices.  Empty slices are no evidence of a link: if a set fills
   more than D slices, it agrees with each partner on at least that many less D that are not
   empty, and leaves out all but the last of these, the most crowded first; so documents
   that share no more than a common passage do not meet in it.  Only if both sets fill at
   most D slices may they differ in every one; such sets, some in a hundred, are cut
   again by another hash, and so on (``CUTS``).
2. Pivots.  Each region takes as pivot the member that shares most slices with others (in
   a group of edited copies that is the original).  All members measure their distance to
   the pivot: a Voronoi cell of documents per pivot, with documents near several pivots
   copied into each of their cells.  Members within ``eps`` of the pivot link to it, and
   need no comparison among themselves.
3. Recursion.  What does not link to its pivot is joined again inside the cell.  The inner
   ball (distance up to 1/2) is re-centred: the symmetric difference with the pivot keeps
   all distances between members and makes the sets small.  The outer part keeps whole
   sets.  Documents of the ball within ``eps`` of its rim are copied into the outer part.
   Each part is cut into blocks by distance to the pivot; by the triangle inequality a
   block needs only members whose distance lies within a window around its own.  A task
   holds the documents of one block (``BLOCK``) and streams the window past them; a wide
   window is dealt to several tasks (``WINDOW``), each with the block.

A pair is compared at most once per shared cell and only links that join two classes are
written, so a group of copies gives as many links as members, not as pairs.  Slices that
repeat inside a batch are combined before the shuffle.

Ids are integers.  Rows with a null id keep their set size and link with nothing; rows
that share an id are one node.  Texts that are null or have no word have an empty set.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chatprep.llm.common import fresh, read_table, release, stage
from chatprep.llm.components import connected_components

SHELL = 0.1  # smallest over largest size of a shell is the similarity less this
SPARE = 1.5  # slices over the number that makes one agree
SALT = 512  # members of a cell that one task measures
BLOCK = 512  # documents held while a window streams past
WINDOW = 1024  # documents of a window that stream past in one task
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
SLICE, LOCAL, SIZE, SHELL_OF = 0, 1, 2, 3
CUT_BITS = 3
CUTS = 1 << CUT_BITS  # the last cut counts empty slices too: about one set in 10**12 gets there
TAG_BITS = 3 + CUT_BITS  # low bits of a slice hash tell the shells and cuts of a document apart
BATCH = 2048


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


def ngram_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-grams of the ASCII-lower-cased words."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix(total * M2 + hashes[k : len(words) - width + 1 + k])
    return np.unique(total)


def _shells(size: int, num: int, den: int) -> list[tuple[int, int]]:
    """(number, largest size) of the shells that hold sets of this size."""
    low, number, found = 1, 0, []
    while low * num <= size * den:  # a set of low n-grams may still link with this one
        high = max(low, int(low / (num / den - SHELL)))
        if size <= high:
            found.append((number, high))
        low, number = high + 1, number + 1
    return found


def _most_differences(size: int, num: int, den: int) -> int:
    """D: the largest symmetric difference of two linked sets of this size."""
    return (den - num) * 2 * size // (den + num)


def slice_hashes(grams: np.ndarray, num: int, den: int) -> tuple[np.ndarray, list[int]]:
    """One hash per slice of every shell and cut of the set; per shell and cut the number of
    slices that can be left out, above the tag that is also in the low bits of their hashes."""
    out, spares = [], []
    mixed = _mix(grams)
    for number, high in _shells(len(grams), num, den):
        most = _most_differences(high, num, den)
        slices = math.ceil(SPARE * (most + 1))
        for cut in range(CUTS):
            spot = grams if cut == 0 else _mix(grams ^ (np.uint64(cut) * M2))
            order = np.argsort(spot, kind="stable")
            place = ((spot[order] >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
            edges = np.searchsorted(place, np.arange(slices + 1, dtype=np.uint64))
            inside = np.concatenate(([np.uint64(0)], np.cumsum(mixed[order])))
            filled = np.flatnonzero(edges[1:] > edges[:-1])
            enough = len(filled) > most
            kept = filled if enough or cut < CUTS - 1 else np.arange(slices)
            tag = (number % 8) << CUT_BITS | cut
            seed = kept.astype(np.uint64) + np.uint64(number << 32 | cut << 56)
            key = _mix((inside[edges[1:]] - inside[edges[:-1]])[kept] * M1 + _mix(seed))
            out.append(key >> np.uint64(TAG_BITS) << np.uint64(TAG_BITS) | np.uint64(tag))
            spares.append(max(len(filled) - most - 1, 0) << TAG_BITS | tag)
            if enough:
                break
    return np.concatenate(out).view(np.int64), spares


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _slices(n: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                ids = whole.column(0).slice(at, BATCH).to_pylist()
                sizes, docs, hashes, shells = [], [], [], []
                for i, text in zip(ids, whole.column(1).slice(at, BATCH)):
                    grams = ngram_set(text.as_py(), n)
                    sizes.append(len(grams))
                    if i is not None and len(grams):
                        mine, spares = slice_hashes(grams, num, den)
                        hashes.append(mine)
                        docs.append(np.full(len(mine), i, np.int64))
                        shells += [(spare, i) for spare in spares]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ids), SIZE, np.int8)),
                        pa.array(sizes, pa.int64()),
                        pa.array(ids, pa.int64()),
                    ],
                    names=["kind", "slice", "doc"],
                )
                if not hashes:
                    continue
                spare, owner = (np.array(c, np.int64) for c in zip(*shells))
                yield _batch(kind=np.full(len(spare), SHELL_OF, np.int8), slice=spare, doc=owner)
                key, doc = np.concatenate(hashes), np.concatenate(docs)
                order = np.lexsort((doc, key))
                key, doc = key[order], doc[order]
                first = np.concatenate(([True], key[1:] != key[:-1]))
                again = ~first | np.concatenate((~first[1:], [False]))
                yield _batch(kind=np.full(first.sum(), SLICE, np.int8), slice=key[first], doc=doc[first])
                if again.any():  # repeats inside the batch go anywhere but to the task of their slice
                    yield _batch(kind=np.full(again.sum(), LOCAL, np.int8), slice=key[again], doc=doc[again])

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (kind, slice, doc): members of slices that occur twice, and all other kinds."""
    last = None  # the last row of kind SLICE, and whether it has been given out
    for batch in batches:
        kind, key, doc = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        mine = kind == SLICE
        rest = batch.filter(pa.array(~mine))
        if rest.num_rows:
            yield rest
        key, doc = key[mine].astype(np.int64), doc[mine].astype(np.int64)
        if not len(key):
            continue
        if last is not None:
            key, doc = np.concatenate(([last[0]], key)), np.concatenate(([last[1]], doc))
        same = key[1:] == key[:-1]
        out = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        given = last is not None and last[2]
        last = (key[-1], doc[-1], bool(out[-1]))
        if given:
            out[0] = False
        if out.any():
            yield _batch(kind=np.full(out.sum(), SLICE, np.int8), slice=key[out], doc=doc[out])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.slice(at, 256).to_pylist() for c in batch.columns))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    spots = np.searchsorted(b, a)
    spots[spots == len(b)] = 0
    return int((b[spots] == a).sum())


DISTANCE = "pivot bigint, doc bigint, size bigint, gap bigint, linked boolean, inner boolean, grams binary"


def _measure(n: int, num: int, den: int):
    """Rows (pivot, salt, role, doc, crowded, text), pivots first in each (pivot, salt), to distances.

    Sets are given out only for members of regions with more than two members: others have
    nobody but the pivot to link with there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in DISTANCE.split(", ")]
        types = [pa.int64()] * 4 + [pa.bool_(), pa.bool_(), pa.binary()]
        rows, weight, here, centres = [], 0, None, []

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for pivot, salt, role, doc, crowded, text in _rows(batches):
            if (pivot, salt) != here:
                here, centres = (pivot, salt), []
            mine = ngram_set(text, n)
            if role == 0:
                centres.append(mine)
                continue
            for centre in centres:
                common = _common(mine, centre)
                union = len(mine) + len(centre) - common
                gap = union - common
                linked = den * common >= num * union
                inner = 2 * common >= union
                # Members of the ball that may link over its rim appear on both sides.
                rim = inner and den * (common - (union + 1) // 2) <= (den - num) * union
                for ball in [True] * inner + [False] * (rim or not inner):
                    kept = None
                    if crowded:
                        kept = (np.setxor1d(mine, centre, assume_unique=True) if ball else mine).tobytes()
                        weight += len(kept)
                    rows.append((pivot, doc, len(mine), gap, linked, ball, kept))
            if len(rows) >= 2048 or weight > 4_000_000:
                if rows:
                    yield flush()
                rows, weight = [], 0
        if rows:
            yield flush()

    return run


def _join_blocks(num: int, den: int):
    """Rows (cell, block, part, role, doc, label, size, grams), the block's own first, to links of classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, index, root, links = None, None, {}, []
        own: list[tuple] = []

        def top(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        def build():
            elements = np.concatenate([g for *_, g in own]) if own else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(own)), [len(g) for *_, g in own])
            order = np.argsort(elements, kind="stable")
            sizes, kept = np.array([s for _, _, s, _ in own]), np.array([len(g) for *_, g in own])
            return elements[order], owner[order], sizes, kept

        for *group, role, doc, label, size, grams in _rows(batches):
            if group != here:
                here, index, root, own = group, None, {}, []
            mine = np.frombuffer(grams, np.uint64)
            if role == 0:
                own.append((doc, label, size, mine))
                continue
            if index is None:
                index = build()
            elements, owner, sizes, kept = index
            left = np.searchsorted(elements, mine, "left")
            count = np.searchsorted(elements, mine, "right") - left
            hit = np.repeat(left - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            shared = np.bincount(owner[hit], minlength=len(own))
            gap = kept + len(mine) - 2 * shared  # re-centring keeps symmetric differences
            union = (sizes + size + gap) // 2
            for k in np.flatnonzero(den * (union - gap) >= num * union):
                a, b = top(own[k][1]), top(label)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    links.append((own[k][0], doc))
            if len(links) >= 10_000:
                yield _links(links)
                links = []
        if links:
            yield _links(links)

    return run


def _links(links: list[tuple]) -> pa.RecordBatch:
    u, v = zip(*links)
    return _batch(u=np.array(u, np.int64), v=np.array(v, np.int64))


def _regions(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc, size) of every row, and (slice, doc) of every slice that several documents share."""
    rows = docs.mapInArrow(_slices(n, num, den), "kind tinyint, slice bigint, doc bigint")
    target = F.when(F.col("kind") == SLICE, F.col("slice")).otherwise(F.xxhash64("doc"))
    sorted_rows = rows.repartition(target).sortWithinPartitions("kind", "slice", "doc")
    found = stage(sorted_rows.mapInArrow(_repeated, "kind tinyint, slice bigint, doc bigint"), "jaccard-regions")
    sizes = stage(found.filter(F.col("kind") == SIZE).select("doc", F.col("slice").alias("size")), "jaccard-sizes")
    members = stage(found.filter(F.col("kind") < SIZE).select("slice", "doc").distinct(), "jaccard-members")
    shells = stage(found.filter(F.col("kind") == SHELL_OF).select("slice", "doc"), "jaccard-shells")
    release(found)
    prefixes = stage(_prefixes(members, shells), "jaccard-prefixes")
    release(members, shells)
    return sizes, prefixes


def _prefixes(members: DataFrame, shells: DataFrame) -> DataFrame:
    """The members without those slices of each document that every partner can spare.

    Linked sets agree on more slices than either can spare in some shell and cut they share,
    so with all slices in one order a document may leave its last ``spare`` ones out: the
    others still meet.  The most crowded slices come last.  ``shells`` has a row (doc, slice)
    per shell and cut of a document: the tag in the low bits, above them the number to spare.
    """
    held = members.groupBy("slice").agg(F.count(F.lit(1)).alias("held"))
    low = F.col("slice").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("shell")
    spares = shells.groupBy("doc", low).agg(F.min(F.shiftright("slice", TAG_BITS)).alias("spare"))
    last = Window.partitionBy("doc", "shell").orderBy(F.col("held").desc(), F.col("slice").desc())
    ranked = members.join(held, "slice").select("doc", low, "slice", "held").withColumn("nth", F.row_number().over(last))
    return ranked.join(spares, ["doc", "shell"]).filter("nth > spare").select("slice", "doc")


def _cells(members: DataFrame) -> DataFrame:
    """(pivot, doc, crowded): every member of a region with the pivot of the region.

    ``crowded`` tells whether a region of both has a third member.
    """
    shared = members.groupBy("doc").agg(F.count(F.lit(1)).alias("shared"))
    weighed = members.join(shared, "doc")
    pivots = weighed.groupBy("slice").agg(
        F.max_by("doc", F.struct("shared", -F.col("doc"))).alias("pivot"), (F.count(F.lit(1)) > 2).alias("crowded")
    )
    pairs = members.join(pivots, "slice").filter(F.col("doc") != F.col("pivot"))
    return stage(pairs.groupBy("pivot", "doc").agg(F.max("crowded").alias("crowded")), "jaccard-cells")


def _distances(docs: DataFrame, cells: DataFrame, n: int, num: int, den: int) -> DataFrame:
    pivots = cells.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / SALT).cast("int").alias("salts"))
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    own = pivots.select("pivot", salts, F.lit(0).alias("role"), F.col("pivot").alias("doc"), F.lit(False).alias("crowded"))
    salt = F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int").alias("salt")
    others = cells.join(pivots, "pivot").select("pivot", salt, F.lit(1).alias("role"), "doc", "crowded")
    laid = (
        own.unionByName(others)
        .join(docs.hint("merge"), "doc")  # one plan for few and many cells
        .select("pivot", "salt", "role", "doc", "crowded", "text")
        .repartition("pivot", "salt")
        .sortWithinPartitions("pivot", "salt", "role")
    )
    return stage(laid.mapInArrow(_measure(n, num, den), DISTANCE), "jaccard-distances")


def _inner_links(distances: DataFrame, num: int, den: int) -> DataFrame:
    """Links between members of a cell of which at least one does not link to its pivot."""
    cell = F.xxhash64("pivot", "inner")
    apart = ~F.col("linked")
    cells = distances.filter("grams IS NOT NULL").withColumn("cell", cell)
    # Blocks of BLOCK documents in order of the distance; ranks run per (cell, distance), never over a whole cell.
    steps = cells.filter(apart).groupBy("cell", "gap").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("cell").orderBy("gap").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("before", F.sum("n").over(running) - F.col("n")).select("cell", "gap", "before", "n")
    own = cells.filter(apart).join(steps, ["cell", "gap"])
    part = F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / BLOCK).cast("bigint"))
    own = own.withColumn("block", F.floor(F.col("before") / BLOCK) * 1_000_000 + part)
    blocks = own.groupBy("cell", "block").agg(F.min("gap").alias("low"), F.max("gap").alias("high"), F.max("size").alias("largest"))
    # Sets within eps differ by (den - num) / (den + num) of their summed sizes at most.
    def reach(size):
        return F.floor((den - num) * (F.col("largest") + size) / (den + num)) + 1

    def inside(size):
        return (F.col("gap") >= F.col("low") - reach(size)) & (F.col("gap") <= F.col("high") + reach(size))

    top = F.col("largest") * den / num
    # How many rows a window may have, by counts per distance, and into how many parts it is dealt.
    counts = cells.groupBy("cell", "gap").agg(F.count(F.lit(1)).alias("n"))
    loads = blocks.join(counts, "cell").filter(inside(top)).groupBy("cell", "block", "low", "high", "largest")
    blocks = loads.agg(F.ceil(F.sum("n") / WINDOW).cast("int").alias("parts"))
    window = cells.join(blocks, "cell").filter(inside(F.least(F.col("size"), top)))
    window = window.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    own = own.join(blocks.select("cell", "block", "parts"), ["cell", "block"]).select("*", copies)
    label = F.when(F.col("linked"), F.col("pivot")).otherwise(F.col("doc")).alias("label")
    laid = (
        own.select("cell", "block", "part", F.lit(0).alias("role"), "doc", label, "size", "grams")
        .unionByName(window.select("cell", "block", "part", F.lit(1).alias("role"), "doc", label, "size", "grams"))
        .repartition("cell", "block", "part")
        .sortWithinPartitions("cell", "block", "part", "role")
    )
    return laid.mapInArrow(_join_blocks(num, den), "u bigint, v bigint")


def jaccard_classes(docs: DataFrame, n: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """(doc, size) of every row of (doc, text), and (node, component) of every linked document."""
    docs = docs.select("doc", F.col("text").cast("binary").alias("text"))
    sizes, members = _regions(docs, n, num, den)
    cells = _cells(members)
    release(members)
    distances = _distances(docs, cells, n, num, den)
    release(cells)
    direct = distances.filter("linked").select(F.col("doc").alias("u"), F.col("pivot").alias("v"))
    classes = connected_components(direct.unionByName(_inner_links(distances, num, den)))
    release(distances)
    return sizes, classes


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` without all but one of each class of near copies.

    Five words and a similarity of 0.8.  The smallest id of a class stays; of rows that
    repeat an id and its text one stays.  Rows with a null id stay.
    """
    _, classes = jaccard_classes(docs.select(F.col("doc_id").alias("doc"), "text"), 5, 8, 10)
    node, nth = fresh(docs, "near_node"), fresh(docs, "near_nth")
    gone = classes.filter(F.col("node") != F.col("component")).select(F.col("node").alias(node))
    left = docs.filter("doc_id IS NOT NULL").join(gone, docs["doc_id"] == gone[node], "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id"))
    left = left.withColumn(nth, first).filter(F.col(nth) == 1).drop(nth)
    return left.unionByName(docs.filter("doc_id IS NULL"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    sizes, classes = jaccard_classes(docs, 3, 90, 100)
    return sizes.join(classes, sizes["doc"] == classes["node"], "left").select(
        F.col("doc").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component", "doc").alias("component_id")
    )


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents
), g AS (
  SELECT DISTINCT rn, doc_id, array_to_string(w[st:st + 2], ' ') AS g
  FROM (SELECT rn, doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS st FROM d WHERE len(w) > 0)
), n AS (
  SELECT rn, doc_id, count(*) AS n FROM g GROUP BY rn, doc_id
), pairs AS (
  SELECT a.rn AS ra, b.rn AS rb, count(*) AS common FROM g a JOIN g b ON a.g = b.g AND a.rn <> b.rn GROUP BY a.rn, b.rn
), links AS (
  SELECT na.doc_id AS u, nb.doc_id AS v
  FROM pairs JOIN n na ON na.rn = ra JOIN n nb ON nb.rn = rb WHERE 100 * common >= 90 * (na.n + nb.n - common)
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM d
  UNION
  SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
), least_of AS (
  SELECT u, min(v) AS component_id FROM reach GROUP BY u
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id
FROM d LEFT JOIN n ON n.rn = d.rn LEFT JOIN least_of ON u = d.doc_id
"""
