"""Removal of repeated word sequences with prefix-partitioned suffix trees.

A window is ``length`` consecutive words of a document.  Words inside a window that also
starts anywhere else are removed.

1. Prefixes.  Only some suffixes are looked at: those that start at an anchor, the least
   8-word prefix (by hash) of some window.  Equal windows have equal anchors at equal
   places, so a repeated window has an anchor whose prefix repeats; all other suffixes are
   dropped before any text moves.
2. Groups.  The suffixes of a repeated prefix form a group, with the words of the windows
   that belong to the anchor.  A group of up to ``GROUP`` suffixes fits in memory; the
   prefix of a larger one is lengthened to the whole window, which makes every group a
   single node of the tree and needs no memory at all.
3. Subtrees.  A task numbers the nodes of its groups' trees at depths 1, 2, 4, ... and
   ``length``; a node at that depth with two suffixes or more is a repeat.

Windows are judged on the input.  Word sequences are compared by 64-bit hashes of their
words (whole windows of large groups by 128 bits).

Ids are integers.  Null and empty texts have no words.  Repeated rows repeat each other's
windows.  Rows without an id go by the hash of their text, and rows that share an id are
told apart by it.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep.llm.common import broadcast_if_small, read_table, release, stage, staged_tables
from chatprep.llm.repeats import KEYED, LOCAL, first_and_again, keyed, repeated

LENGTH = 35
PREFIX = 8
GROUP = 2000  # suffixes of one group that a task holds
BATCH = 1024
P = np.uint64(0x9E3779B97F4A7C15)
Q = np.uint64(0xC2B2AE3D27D4EB4F)


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _window_hashes(words: np.ndarray, width: int, seed: np.uint64) -> np.ndarray:
    total = np.full(max(len(words) - width + 1, 0), width, np.uint64)
    for k in range(width):
        total = (total ^ words[k : k + len(total)]) * seed
        total ^= total >> np.uint64(29)
    return total


def _sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum of every run of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = least(x[:-done], x[done:])
        done *= 2
    return least(x[: len(x) - (width - done)], x[width - done :]) if width > done else x


def anchors(words: np.ndarray, length: int = LENGTH, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions, prefix hashes, least prefix of every window)."""
    if len(words) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    grams = _window_hashes(words, prefix, P)
    width = length - prefix + 1
    low = _sliding(grams, width, np.minimum)  # per window start
    edge = np.zeros(width - 1, np.uint64)
    high = _sliding(np.concatenate((edge, low, edge)), width, np.maximum)  # per prefix position
    chosen = np.flatnonzero(high == grams)
    return chosen, grams[chosen], low


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                keys, docs, digests, places = [], [], [], []
                ids, marks, texts = (whole.column(k).slice(at, BATCH) for k in range(3))
                for i, digest, text in zip(ids.to_pylist(), marks.to_pylist(), texts):
                    where, gram, _ = anchors(_word_hashes(_words(text.as_py())), length)
                    keys.append(gram.view(np.int64))
                    docs.append(np.full(len(where), i, np.int64))
                    digests.append(np.full(len(where), digest, np.int64))
                    places.append(where.astype(np.int32))
                key, doc, mark, place = map(np.concatenate, (keys, docs, digests, places))
                if len(key):
                    order, first, again = first_and_again(key, np.zeros_like(key))
                    for kind, rows in ((KEYED, order[first]), (LOCAL, order[again])):
                        none = np.zeros(len(rows), np.int64)
                        yield keyed(kind, {"key": key[rows], "check": none, "doc": doc[rows], "digest": mark[rows], "place": place[rows]})

    return run


def _suffixes(length: int, prefix: int = PREFIX):
    """Rows (doc, digest, text, places, large) to suffixes: the words of all windows of an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "large", "doc", "digest", "first", "words"]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = []
                for doc, digest, text, places, large in zip(*(batch.column(k).slice(at, 64).to_pylist() for k in range(5))):
                    words = _word_hashes(_words(text))
                    where, gram, low = anchors(words, length)
                    big = set(large)
                    kept, before = set(places), {}
                    for p, g in zip(where.tolist(), gram):
                        # The windows whose least prefix is at p, and at no place before p.
                        start = max(0, p - (length - prefix), before.get(g, -1) + 1)
                        before[g] = p
                        if p not in kept:
                            continue
                        mine = np.flatnonzero(low[start : min(p, len(low) - 1) + 1] == g)
                        if len(mine):
                            first, last = start + int(mine[0]), start + int(mine[-1])
                            rows.append((int(g.view(np.int64)), p in big, doc, digest, first, words[first : last + length].tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return run


def _flat(batch: pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all suffixes in one array; of each full window its start there, its suffix, its place in the text."""
    column = batch.column("words")
    edges = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 8
    words = np.frombuffer(column.buffers()[2], np.uint64, int(edges[-1]))[edges[0] :]
    edges = edges - edges[0]
    sizes = np.diff(edges)
    suffix = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - edges[suffix]
    starts = np.flatnonzero(place <= sizes[suffix] - length)
    first = batch.column("first").to_numpy().astype(np.int64)
    return words, starts, suffix[starts], first[suffix[starts]] + place[starts]


def _spans(batch: pa.RecordBatch, suffix: np.ndarray, start: np.ndarray) -> dict[str, np.ndarray]:
    """Window starts joined to runs (doc, digest, first, last)."""
    doc, digest = (batch.column(c).to_numpy()[suffix] for c in ("doc", "digest"))
    order = np.lexsort((start, digest, doc))
    doc, digest, start = doc[order], digest[order], start[order]
    cut = (doc[1:] != doc[:-1]) | (digest[1:] != digest[:-1]) | (start[1:] > start[:-1] + 1)
    head, tail = np.concatenate(([True], cut)), np.concatenate((cut, [True]))
    return {"doc": doc[head], "digest": digest[head], "first": start[head], "last": start[tail]}


def nodes_at_depth(words: np.ndarray, depth: int) -> np.ndarray:
    """For every suffix of the array that has ``depth`` words, the number of its node at that depth.

    Suffixes share a node if they share as many words.  Nodes at depth 2d are pairs of nodes
    at depth d, so the numbers are exact and take log(depth) sorts.
    """
    nodes, done = np.unique(words, return_inverse=True)[1], 1
    while done < depth:
        step = min(done, depth - done)
        pairs = nodes[: len(nodes) - step] * np.int64(len(words)) + nodes[step:]
        nodes, done = np.unique(pairs, return_inverse=True)[1], done + step
    return nodes


def _subtrees(length: int):
    """Suffixes sorted by anchor to runs of windows that share a node at depth ``length``."""

    def repeats(held: pa.RecordBatch) -> pa.RecordBatch | None:
        words, starts, suffix, place = _flat(held, length)
        node = nodes_at_depth(words, length)[starts]
        deep = np.bincount(node)[node] > 1
        if not deep.any():
            return None
        spans = _spans(held, suffix[deep], place[deep])
        return pa.RecordBatch.from_arrays([pa.array(v) for v in spans.values()], names=list(spans))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            anchor = held.column("anchor").to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))  # the last group may go on
            if cut:
                if (found := repeats(held.slice(0, cut))) is not None:
                    yield found
                held = held.slice(cut)
        if held is not None and held.num_rows and (found := repeats(held)) is not None:
            yield found

    return run


def _long_prefixes(length: int):
    """Suffixes of large groups to one keyed row per window, or to runs where a batch repeats them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, starts, suffix, place = _flat(batch, length)
            key, check = (_window_hashes(words, length, seed)[starts].view(np.int64) for seed in (P, Q))
            order, first, again = first_and_again(key, check)
            one = order[first]
            doc, digest = (batch.column(c).to_numpy()[suffix[one]] for c in ("doc", "digest"))
            yield keyed(KEYED, {"key": key[one], "check": check[one], "doc": doc, "digest": digest, "first": place[one], "last": place[one]})
            if again.any():
                spans = _spans(batch, suffix[order[again]], place[order[again]])
                none = np.zeros(len(spans["doc"]), np.int64)
                yield keyed(LOCAL, {"key": none, "check": none, **spans})

    return run


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, digest, spans): for (doc, digest, text) rows with repeats, runs of starts of repeated windows.

    ``doc`` is never null; rows with the same (doc, digest) are copies.
    """
    docs = docs.select("doc", "digest", F.col("text").cast("binary").alias("text"))
    found = stage(repeated(docs, _anchor_rows(length), "doc bigint, digest bigint, place int"), "repeated-prefixes")
    large = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > GROUP).select("key", F.lit(True).alias("large"))
    marked = found.join(broadcast_if_small(stage(large, "large-groups")), "key", "left")
    # Texts that share an id have places of their own: two suffixes of one prefix go the same way, whoever holds them.
    places = marked.groupBy("doc", "digest").agg(
        F.collect_set("place").alias("places"), F.collect_set(F.when(F.col("large"), F.col("place"))).alias("large")
    )
    chosen = docs.join(places, ["doc", "digest"]).select("doc", "digest", "text", "places", "large")
    suffixes = stage(
        chosen.mapInArrow(_suffixes(length), "anchor bigint, large boolean, doc bigint, digest bigint, first bigint, words binary"),
        "suffixes",
    )
    release(found)
    spans = "doc bigint, digest bigint, first bigint, last bigint"
    groups = suffixes.filter("NOT large").drop("large").repartition("anchor").sortWithinPartitions("anchor")
    trees = groups.mapInArrow(_subtrees(length), spans)
    nodes = repeated(suffixes.filter("large").drop("large", "anchor"), _long_prefixes(length), spans).drop("key")
    return trees.unionByName(nodes).groupBy("doc", "digest").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids = batch.column(0).slice(at, 256)
                total, gone, kept = [], [], []
                for text, spans in zip(*(batch.column(k).slice(at, 256).to_pylist() for k in (1, 2))):
                    words = _words(text)
                    if spans:
                        edge = np.zeros(len(words) + 1, np.int32)
                        np.add.at(edge, [s["first"] for s in spans], 1)
                        np.add.at(edge, [s["last"] + length for s in spans], -1)
                        clear = np.cumsum(edge[:-1]) == 0
                        left = [w for w, c in zip(words, clear.tolist()) if c]
                    else:
                        left = words
                    total.append(len(words))
                    gone.append(len(words) - len(left))
                    kept.append(b" ".join(left).decode())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc, n_words, n_removed, kept) of every (doc, text) row; kept words are joined by blanks."""
    digest = F.xxhash64("text")
    rows = docs.select(F.col("doc").alias("id"), F.coalesce("doc", digest).alias("doc"), digest.alias("digest"), "text")
    with staged_tables() as tables:
        spans = tables.keep(stage(repeated_windows(rows, length), "repeated-windows"))
    joined = rows.join(spans, ["doc", "digest"], "left")
    return joined.select("id", F.col("text").cast("binary"), "spans").mapInArrow(
        _remove(length), "doc bigint, n_words bigint, n_removed bigint, kept string"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text")
    return remove_repeats(docs).select(F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (
  SELECT rn, st, array_to_string(w[st:st + 34], ' ') AS g
  FROM (SELECT rn, w, unnest(range(1, len(w) - 33)) AS st FROM d WHERE len(w) >= 35)
), again AS (
  SELECT rn, st FROM starts JOIN (SELECT g FROM starts GROUP BY g HAVING count(*) > 1) USING (g)
), gone AS (
  SELECT DISTINCT rn, unnest(range(st, st + 35)) AS p FROM again
), words AS (
  SELECT rn, p, w[p] AS word FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS p FROM d)
), kept AS (
  SELECT rn, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (rn, p) GROUP BY rn
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rn)
"""
