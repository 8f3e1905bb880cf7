"""CSV whose cells hold line breaks, read by many tasks.

A line alone doesn't tell whether it starts inside a quoted cell.  What it does to that
state is a function of two values: the state behind the line if it starts outside, and if
it starts inside.  A first pass composes the functions of each file split, which leaves one
row per split; composing those over the splits of a file gives the state at which each
split starts.  With it a second pass cuts every split into records on its own.  A record
that crosses split borders comes in fragments, which are put together afterwards; all
other records stay in the task that read them, and no text is shuffled for them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chatprep.sources.order import ORDER_COLUMNS, with_order_columns

# What runs in Python workers travels by value: executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE, INSIDE = 0, 1
WHOLE, HEAD, REST = 0, 1, 2
ROWS, CHARS = 4096, 1 << 22  # records and characters of a batch


def _after(line: str, state: int) -> int:
    """The state behind a line that starts in ``state``.

    A quote opens a cell only where a cell starts, two quotes in a quoted cell stand for
    one, and quotes anywhere else are ordinary characters.
    """
    inside, pending, at_start = state == INSIDE, False, True
    pieces = line.split('"')
    for n, piece in enumerate(pieces):
        if piece and not (inside and not pending):  # text outside, maybe behind a closing quote
            inside = pending = False
            at_start = piece.endswith(",")
        if n == len(pieces) - 1:
            break
        if inside:
            pending = not pending
        elif at_start:
            inside, pending, at_start = True, False, False
    return INSIDE if inside and not pending else OUTSIDE


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order to (file, block, outside, inside): where a split leads from either state."""
    here, states, done = None, None, []
    for batch in batches:
        for line, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "_file", "_block"))):
            if (file, block) != here:
                if here:
                    done.append((*here, *states))
                here, states = (file, block), (OUTSIDE, INSIDE)
            if '"' in line:
                one = _after(line, states[0])
                states = one, one if states[0] == states[1] else _after(line, states[1])
            elif states[0] != states[1]:
                pass  # a line without quotes leaves both states as they are
    if here:
        done.append((*here, *states))
    if done:
        types = [pa.string(), pa.int64(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=["_file", "_block", "outside", "inside"])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the state their split starts in to records and fragments."""
    names = [*ORDER_COLUMNS, "kind", "head", "record"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    out: list[tuple] = []
    size = 0
    here, state, held, first, kind, head = None, OUTSIDE, [], 0, WHOLE, False

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    for batch in batches:
        for line, file, block, place, start in zip(*(batch.column(c).to_pylist() for c in ("value", *ORDER_COLUMNS, "start"))):
            if (file, block) != here:
                if held:  # open at the end of its split
                    out.append((*here, first, HEAD if kind == WHOLE else REST, head, "\n".join(held) + "\n"))
                here, state, held, kind = (file, block), start, [], REST if start == INSIDE else WHOLE
                head = block == 0
            if not held:
                first = place
            held.append(line)
            if '"' in line:
                state = _after(line, state)
            if state == OUTSIDE:
                record = "\n".join(held)
                if record not in ("", "\r"):
                    out.append((file, block, first, kind, head, record))
                    size += len(record)
                    head = False
                held, kind = [], WHOLE
            if len(out) >= ROWS or size > CHARS:
                yield flush()
                out, size = [], 0
    if held:
        out.append((*here, first, HEAD if kind == WHOLE else REST, head, "\n".join(held) + "\n"))
    if out:
        yield flush()


def _starts(splits: DataFrame) -> DataFrame:
    """(file, block) of the splits that start inside a cell; one row per split comes in.

    A split either sets the state, whatever it was, or keeps it, or turns it round: the
    state is that behind the last split that set it, turned by the splits since.
    """
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sets, turns = F.col("outside") == F.col("inside"), (F.col("outside") == INSIDE) & (F.col("inside") == OUTSIDE)
    upto = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, 0)
    counted = splits.withColumn("turned", F.sum(turns.cast("int")).over(upto))
    last = F.last(F.when(sets, F.struct("outside", "turned")), ignorenulls=True).over(before)
    turned = F.coalesce(F.sum(turns.cast("int")).over(before), F.lit(0))
    state = F.coalesce(last["outside"], F.lit(OUTSIDE)) + turned - F.coalesce(last["turned"], F.lit(0))
    return counted.select("_file", "_block", F.pmod(state, F.lit(2)).cast("int").alias("start")).filter(F.col("start") == INSIDE)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``, ``head`` and the order columns of its first line, for every record that is not empty.

    ``head`` marks the first record of a file.  Line feeds end lines; a carriage return before one goes with it outside of cells.
    """
    lines = with_order_columns(spark.read.option("lineSep", "\n").text(path))
    splits = lines.select("value", "_file", "_block").mapInArrow(_split_functions, "_file string, _block bigint, outside int, inside int")
    # One row per split that starts in a cell: 100 TB are fewer than a million splits.
    marked = lines.join(F.broadcast(_starts(splits)), ["_file", "_block"], "left").withColumn("start", F.coalesce("start", F.lit(OUTSIDE)))
    cut = marked.select("value", *ORDER_COLUMNS, "start").mapInArrow(_records, "_file string, _block bigint, _place bigint, kind int, head boolean, record string")
    whole = cut.filter(F.col("kind") == WHOLE).drop("kind")
    # Fragments: at most two of a split.  Those from one head to the next are one record.
    order = Window.partitionBy("_file").orderBy("_block", F.col("kind").desc())
    parts = cut.filter(F.col("kind") != WHOLE).withColumn("nth", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    joined = parts.groupBy("_file", "nth").agg(
        F.min(F.struct("_block", F.lit(-1) * F.col("kind"), "_place", "head")).alias("first"),
        F.array_sort(F.collect_list(F.struct("_block", F.lit(-1) * F.col("kind"), "record"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["record"]), "")
    mended = joined.select("_file", *[F.col(f"first.{c}").alias(c) for c in ("_block", "_place", "head")], text.alias("record"))
    # A cell that is still open at the end of the file has a line end too many.
    mended = mended.withColumn("record", F.regexp_replace("record", r"\n\z", ""))
    record = F.regexp_replace("record", r"\r\z", "")
    return whole.unionByName(mended).withColumn("record", record).filter(F.col("record") != "")
