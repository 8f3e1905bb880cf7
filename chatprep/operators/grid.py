"""Scores of queries and documents in a grid of query blocks and document buckets.

A cell holds the weights of one block of queries and the postings of one bucket of
documents.  The weights become matrices of terms and queries, a few documents at a time a
matrix of documents and terms, and their products are the scores.  The cell keeps the best
``k`` documents of every query, so neither matches nor the scores of pairs that are not
among the best are ever shuffled.  Postings are streamed past the weights: memory holds one
block of weights and the scores of a few documents, however many postings a bucket has.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

# What runs in Python workers travels by value: executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_WEIGHTS = 1 << 18  # weights a task holds
ENTRIES = 1 << 20  # numbers in a matrix of terms and queries, documents and terms, or documents and queries
MOST_TASKS = 20_000  # beyond it a task works on several cells
DIGITS = 1e9  # scores that agree to nine digits are ties


def _runs(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Values of runs of equal neighbours, and for every row the number of its run."""
    ended = pa.compute.run_end_encode(values)
    ends = ended.run_ends.to_numpy()
    return ended.values, np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))


class _Cell:
    """Weights of a block, then postings by document; yields the best documents of each query."""

    def __init__(self, k: int | None):
        self.k = k
        self.weights: list[pa.RecordBatch] = []
        self.queries = None
        self.open_doc, self.open_scores = None, None  # the last document, which may go on
        self.best: tuple[np.ndarray, np.ndarray, pa.Array] | None = None
        self.out: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.least = None

    def _prepare(self) -> None:
        """Weights of neighbouring queries as matrices of terms x queries."""
        rows = pa.Table.from_batches(self.weights)
        self.weights = []
        coded = rows.column("query_id").combine_chunks().dictionary_encode(null_encoding="encode")
        query = coded.indices.to_numpy()
        order = np.argsort(query, kind="stable")
        self.queries, query = coded.dictionary, query[order]
        term, weight = (rows.column(c).to_numpy()[order] for c in ("tid", "value"))
        ends = np.searchsorted(query, np.arange(1, len(self.queries) + 1))
        self.groups, q = [], 0
        self.terms = np.unique(term)
        while q < len(self.queries):
            start, upto = (ends[q - 1] if q else 0), q + 1
            while upto < len(self.queries) and (ends[upto] - start) * (upto + 1 - q) <= ENTRIES:
                upto += 1
            mine = slice(start, ends[upto - 1])
            terms, place = np.unique(term[mine], return_inverse=True)
            flat = np.bincount(place * (upto - q) + query[mine] - q, weight[mine], len(terms) * (upto - q))
            spot = np.full(len(self.terms), -1)  # of every term of the block, its row in the matrix
            spot[np.searchsorted(self.terms, terms)] = np.arange(len(terms))
            self.groups.append((q, upto, spot, flat.reshape(len(terms), upto - q)))
            q = upto
        self.most = max(1, ENTRIES // max(len(self.queries), *(len(weights) for *_, weights in self.groups)))
        self.least = np.full(len(self.queries), -np.inf)

    def add_weights(self, batch: pa.RecordBatch) -> None:
        self.weights.append(batch)

    def add_postings(self, batch: pa.RecordBatch) -> None:
        if self.queries is None:
            if not self.weights:
                return
            self._prepare()
        tid, share = batch.column("tid").to_numpy(), 1.0 + np.log(batch.column("value").to_numpy())
        docs, doc = _runs(batch.column("doc_seq"))
        place = np.minimum(np.searchsorted(self.terms, tid), len(self.terms) - 1)
        held = self.terms[place] == tid
        doc, place, share = doc[held], place[held], share[held]
        ends = np.searchsorted(doc, np.arange(1, len(docs) + 1))
        for at in range(0, len(docs), self.most):
            upto = min(at + self.most, len(docs))
            mine = slice(ends[at - 1] if at else 0, ends[upto - 1])
            self._score(docs.slice(at, upto - at), doc[mine] - at, place[mine], share[mine])

    def _score(self, docs: pa.Array, doc: np.ndarray, term: np.ndarray, share: np.ndarray) -> None:
        scores = np.empty((len(docs), len(self.queries)))
        for first, last, spots, weights in self.groups:
            spot = spots[term]
            held, width = spot >= 0, len(weights)
            flat = np.bincount(doc[held] * width + spot[held], share[held], len(docs) * width)
            scores[:, first:last] = flat.reshape(len(docs), width) @ weights
        if self.open_doc is not None:
            if docs[0] == self.open_doc[0]:
                scores[0] += self.open_scores
            else:
                self._keep(self.open_doc, self.open_scores[None, :])
        self.open_doc, self.open_scores = docs.slice(len(docs) - 1), scores[-1].copy()
        if len(docs) > 1:
            self._keep(docs.slice(0, len(docs) - 1), scores[:-1])

    def _keep(self, docs: pa.Array, scores: np.ndarray) -> None:
        place = np.floor(scores * DIGITS + 0.5)
        row, query = np.nonzero((scores > 0) & (place >= self.least[None, :]))
        if not len(row):
            return
        found = query, scores[row, query], docs.take(pa.array(row))
        if self.k is None:
            self.out.append(found)
            return
        if self.best is not None:
            found = (*(np.concatenate(pair) for pair in zip(self.best[:2], found)), pa.concat_arrays([self.best[2], found[2]]))
        query, score, docs = found
        rounded = np.floor(score * DIGITS + 0.5)
        order = np.lexsort((np.arange(len(query)), -rounded, query))  # documents come in order
        query = query[order]
        starts = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
        nth = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        kept = np.sort(order[nth < self.k])  # back in document order
        self.best = found[0][kept], score[kept], docs.take(pa.array(kept))
        full = nth == self.k - 1
        self.least[query[full]] = rounded[order][full]

    def rows(self, last: bool) -> Iterator[pa.RecordBatch]:
        if last and self.open_doc is not None:
            self._keep(self.open_doc, self.open_scores[None, :])
            self.open_doc = None
        if last and self.best is not None:
            self.out.append(self.best)
            self.best = None
        for query, score, docs in self.out:
            names = ["query_id", "doc_seq", "score"]
            yield pa.RecordBatch.from_arrays([self.queries.take(pa.array(query)), docs, pa.array(score)], names=names)
        self.out = []


def _listed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A row per value of rows with lists of ``tid`` and ``value``, about ``ENTRIES`` of them at once."""
    if not pa.types.is_list(batch.column("tid").type):
        yield batch
        return
    sizes = pa.compute.list_value_length(batch.column("tid")).to_numpy()
    number = np.cumsum(sizes, dtype=np.int64) // ENTRIES
    cuts = np.flatnonzero(number[1:] != number[:-1]) + 1
    for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        part = batch.slice(start, end - start)
        row = pa.array(np.repeat(np.arange(end - start), sizes[start:end]))
        columns = [part.column(c).flatten() if c in ("tid", "value") else part.column(c).take(row) for c in part.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)


def packed_schema(documents: DataFrame) -> T.StructType:
    lists = [T.StructField("tid", T.ArrayType(T.LongType())), T.StructField("tf", T.ArrayType(T.DoubleType()))]
    return T.StructType([T.StructField("doc_seq", documents.schema["doc_seq"].dataType), *lists])


def pack_postings(postings: DataFrame) -> DataFrame:
    """``doc_seq, tid, tf`` with lists of terms: neighbouring rows of a document become one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                docs, doc = _runs(batch.column("doc_seq"))
                offsets = pa.array(np.searchsorted(doc, np.arange(len(docs) + 1)), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, batch.column(c)) for c in ("tid", "tf")]
                yield pa.RecordBatch.from_arrays([docs, *lists], names=["doc_seq", "tid", "tf"])

    rows = postings.select("doc_seq", "tid", F.col("tf").cast("double").alias("tf"))
    return rows.mapInArrow(run, packed_schema(postings))


def _score_cells(k: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell = None, _Cell(k)
        for batch in (part for whole in batches for part in _listed(whole)):
            number, role = batch.column("cell").to_numpy(), batch.column("role").to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (role[1:] != role[:-1])) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if number[start] != here:
                    yield from cell.rows(last=True)
                    here, cell = number[start], _Cell(k)
                part = batch.slice(start, end - start)
                if role[start]:
                    cell.add_postings(part)
                    yield from cell.rows(last=False)
                else:
                    cell.add_weights(part)
        yield from cell.rows(last=True)

    return run


def grid_scores(weights: DataFrame, postings: DataFrame, blocks: int, buckets: int, k: int | None = None) -> DataFrame:
    """``query_id, doc_seq, score``: of every cell the best ``k`` documents per query, or all.

    Postings without a document are left out.  ``weights`` has query_id, tid and weight,
    ``postings`` doc_seq, tid and tf, or lists of the last two (``pack_postings``).
    """
    query_type, doc_type = weights.schema["query_id"].dataType, postings.schema["doc_seq"].dataType

    def cells(df, own, others, cell):
        return df.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).withColumn("cell", cell)

    packed = isinstance(postings.schema["tid"].dataType, T.ArrayType)
    one = F.array if packed else F.col
    value = F.col("tf") if packed else F.col("tf").cast("double")
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    bucket = F.pmod(F.xxhash64("doc_seq"), F.lit(buckets))
    left = cells(weights, block, buckets, F.col("_own") * buckets + F.col("_other")).select(
        "cell", F.lit(0).cast("int").alias("role"), "query_id", F.lit(None).cast(doc_type).alias("doc_seq"), one("tid").alias("tid"), one("weight").alias("value")
    )
    right = cells(postings.filter("doc_seq IS NOT NULL"), bucket, blocks, F.col("_other") * buckets + F.col("_own")).select(
        "cell", F.lit(1).cast("int").alias("role"), F.lit(None).cast(query_type).alias("query_id"), "doc_seq", "tid", value.alias("value")
    )
    tasks = min(blocks * buckets, MOST_TASKS)
    laid = left.unionByName(right).repartitionById(tasks, (F.col("cell") % tasks).cast("int"))
    # Weights have no document and come first.  A single key, where a task has one cell:
    # Spark sorts numbers by radix.
    cell = [F.col("cell")] if tasks < blocks * buckets else []
    laid = laid.sortWithinPartitions(*cell, F.col("doc_seq").asc_nulls_first())
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("doc_seq", doc_type), T.StructField("score", T.DoubleType())])
    return laid.mapInArrow(_score_cells(k), schema)


def _postings(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
    """The terms of a block with their lists, as postings in order of documents."""
    lists = [pa.concat_arrays([p.column(c) for p in parts]) for c in ("docs", "value")]
    sizes = pa.compute.list_value_length(lists[0]).to_numpy()
    tid = np.repeat(np.concatenate([p.column("tid").flatten().to_numpy() for p in parts]), sizes)
    docs, value = (c.flatten() for c in lists)
    coded, value = docs.dictionary_encode(), value.to_numpy()
    index = coded.indices.fill_null(-1).to_numpy()
    sorting = pa.compute.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(sorting) + 1, np.int64)
    rank[sorting], rank[-1] = np.arange(len(sorting)), -1  # postings without a document
    place = rank[index]
    order = np.argsort(place, kind="stable")[np.count_nonzero(place < 0) :]
    if not len(order):
        return None
    ordered = coded.dictionary.take(pa.array(sorting)).take(pa.array(place[order]))
    return pa.RecordBatch.from_arrays([ordered, pa.array(tid[order]), pa.array(value[order])], names=["doc_seq", "tid", "value"])


def _score_blocks(k: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, cell, parts = None, _Cell(k), []

        def end():
            nonlocal parts
            if parts and (postings := _postings(parts)) is not None:
                cell.add_postings(postings)
            parts = []

        for batch in batches:
            number, block = (batch.column(c).to_numpy() for c in ("cell", "block"))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (block[1:] != block[:-1])) + 1
            for start, upto in zip([0, *cuts], [*cuts, batch.num_rows]):
                if start == upto:
                    continue
                if (number[start], block[start]) != here:
                    end()
                    if here is None or number[start] != here[0]:
                        yield from cell.rows(last=True)
                        cell = _Cell(k)
                    else:
                        yield from cell.rows(last=False)
                    here = number[start], block[start]
                part = batch.slice(start, upto - start)
                if block[start] < 0:
                    for weights in _listed(part.select(["query_id", "tid", "value"])):
                        cell.add_weights(weights)
                else:
                    parts.append(part)
        end()
        yield from cell.rows(last=True)

    return run


def block_scores(weights: DataFrame, blocks: DataFrame, queries_in: int, parts: int, k: int | None = None) -> DataFrame:
    """``query_id, doc_seq, score`` like ``grid_scores``, of ``part, block, tid, docs, tfs``.

    A block of queries meets a part of the documents in a cell; the lists of a block of
    documents stay together on the way and are put in order of documents there.
    ``queries_in`` is the number of blocks of queries.
    """
    query_type, docs_type = weights.schema["query_id"].dataType, blocks.schema["docs"].dataType
    own = F.pmod(F.xxhash64("query_id"), F.lit(queries_in)).cast("long")
    listed = weights.groupBy("query_id").agg(F.collect_list("tid").alias("tid"), F.collect_list("weight").alias("value"))
    left = listed.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part")).select(
        (own * parts + F.col("_part")).alias("cell"), F.lit(-1).cast("long").alias("block"), "query_id", F.lit(None).cast(docs_type).alias("docs"), "tid", "value"
    )
    right = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(queries_in - 1))).alias("_own")).select(
        (F.col("_own").cast("long") * parts + F.col("part")).alias("cell"),
        "block",
        F.lit(None).cast(query_type).alias("query_id"),
        "docs",
        F.array("tid").alias("tid"),
        F.col("tfs").cast("array<double>").alias("value"),
    )
    tasks = min(queries_in * parts, MOST_TASKS)
    laid = left.unionByName(right).repartitionById(tasks, (F.col("cell") % tasks).cast("int"))
    # Weights come first.
    laid = laid.sortWithinPartitions("cell", "block")
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("doc_seq", docs_type.elementType), T.StructField("score", T.DoubleType())])
    return laid.mapInArrow(_score_blocks(k), schema)
