"""Rows whose key occurs at least twice in a table of keys, in one shuffle.

A mapper combines the repeats inside a batch: they are known to be repeated, so they
travel by their payload, and one row per key and batch travels by key.  A key that a third
of all rows share therefore sends one row per batch to its task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYED, LOCAL = 0, 1


def first_and_again(key: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key; and in that order the first row of each key, and all rows of repeated keys."""
    order = np.lexsort((check, key))
    key, check = key[order], check[order]
    first = np.concatenate(([True], (key[1:] != key[:-1]) | (check[1:] != check[:-1])))
    return order, first, ~first | np.concatenate((~first[1:], [False]))


def keyed(kind: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A batch of one kind: key and check first, then the payload."""
    rows = len(columns["key"])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, kind, np.int8)), *map(pa.array, columns.values())], names=["kind", *columns]
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (kind, key, check): those whose key has a neighbour, and all local ones."""
    last, given = None, False  # the last keyed row as a batch of one, and whether it went out
    for batch in batches:
        by_key = batch.column(0).to_numpy(zero_copy_only=False) == KEYED
        payload = [n for n in batch.schema.names if n not in ("kind", "check")]
        rest = batch.filter(pa.array(~by_key))
        if rest.num_rows:
            yield rest.select(payload)
        mine = batch.filter(pa.array(by_key))
        if not mine.num_rows:
            continue
        if last is not None:
            mine = pa.concat_batches([last, mine])
        key, check = (mine.column(c).to_numpy(zero_copy_only=False) for c in ("key", "check"))
        same = (key[1:] == key[:-1]) & (check[1:] == check[:-1])
        out = np.concatenate(([False], same)) | np.concatenate((same, [False]))
        tail = bool(out[-1])
        if given:
            out[0] = False
        last, given = mine.slice(mine.num_rows - 1), tail
        if out.any():
            yield mine.filter(pa.array(out)).select(payload)


def repeated(rows: DataFrame, batches: Callable, payload: str) -> DataFrame:
    """(key, payload) of repeated keys; ``batches`` turns Arrow batches of ``rows`` into keyed ones.

    A row may come twice.
    """
    found = rows.mapInArrow(batches, f"kind tinyint, key bigint, check bigint, {payload}")
    names = [column.split()[0] for column in payload.split(", ")]
    target = F.when(F.col("kind") == KEYED, F.col("key")).otherwise(F.xxhash64(*names))
    laid = found.repartition(target).sortWithinPartitions("kind", "key", "check")
    return laid.mapInArrow(_runs, f"key bigint, {payload}")
