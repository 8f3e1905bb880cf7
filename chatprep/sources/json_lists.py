"""Large JSON lists, read by many tasks.

A file is read as pieces that end at closing braces, so a list on one line is cut like any
other.  Where a split starts, it is unknown whether that is inside a string and how many
brackets are open, but what the split does to both is a function of whether it starts in a
string: quotes turn that round, and the brackets outside of strings add up.  A first pass
leaves these functions, one row per split; their running sums over a file give the state at
which each split starts.  With it a second pass cuts every split into the elements of the
list on its own.  An element that crosses split borders comes in fragments, which are put
together afterwards; all others stay in the task that read them.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chatprep.functions.text import is_blank
from chatprep.sources.order import Files, scan_in_order

# What runs in Python workers travels by value: executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE, HEAD, REST = 0, 1, 2
ROWS, CHARS = 4096, 1 << 22  # elements and characters of a batch
ESCAPED = re.compile(r"\\.", re.S)
MARKS = re.compile(r'"[^"]*"|["\[\]{},]')
FAULT = "!"  # closes what cannot be part of a list


def _net(text: str) -> int:
    return text.count("{") + text.count("[") - text.count("}") - text.count("]")


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order to (file, block, turns, outside, inside, opens).

    ``turns``: does the split lead from inside to outside of a string and back;
    ``outside`` and ``inside``: by how much it deepens, by the state it starts in;
    ``opens``: its first character that is not white space.
    """
    names = ["_file", "_block", "turns", "outside", "inside", "opens"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
    here, turned, deeper, opens, done = None, 0, [0, 0], "", []
    for batch in batches:
        for piece, file, block in zip(*(batch.column(c).to_pylist() for c in ("value", "_file", "_block"))):
            if (file, block) != here:
                if here:
                    done.append((*here, turned, *deeper, opens))
                here, turned, deeper, opens = (file, block), 0, [0, 0], ""
            opens = opens or (piece + "}").lstrip("﻿ \t\r\n")[:1]
            parts = ESCAPED.sub("", piece).split('"')
            # Started outside, the split is outside of strings now if it has turned an even number of times.
            deeper[turned] += _net("".join(parts[0::2]))
            deeper[1 - turned] += _net("".join(parts[1::2]))
            turned ^= (len(parts) - 1) & 1
            deeper[turned] -= 1  # the brace that ends the piece
    if here:
        done.append((*here, turned, *deeper, opens))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces with the state their split starts in to elements and fragments of them."""
    names = ["_file", "_block", "_place", "kind", "opener", "closer", "element"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string()]
    out: list[tuple] = []
    here, last, quoted, depth, parts, kind, opener, count = None, False, False, 0, [], WHOLE, "", 0

    def close(text: str, by: str) -> None:
        nonlocal parts, kind, count
        out.append((*here, count, kind, opener, by, "".join(parts) + text))
        parts, kind, count = [], WHOLE, count + 1

    def end() -> None:
        """What is left when a split ends: behind its last piece is a brace, but for the end of the file."""
        nonlocal quoted, depth
        if not last:
            quoted, depth = _brace(quoted, depth)
            parts.append("}")
            if not depth and not quoted:
                close("", FAULT)
        if last and (depth or quoted):
            close("", FAULT)
        elif depth:  # an element of the list is open
            out.append((*here, count, HEAD if kind == WHOLE else REST, opener, "", "".join(parts)))
        elif "".join(parts).strip(" \t\r\n﻿"):
            close("", FAULT)  # text outside of the list

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    columns = ("value", "_file", "_block", "quoted", "depth", "last")
    previous = None  # the piece before: only the next one tells whether a brace ended it
    for batch in batches:
        for piece, file, block, in_string, level, is_last in zip(*(batch.column(c).to_pylist() for c in columns)):
            if (file, block) != here:
                if here:
                    end()
                here, last, quoted, depth, parts, count = (file, block), is_last, in_string, level, [], 0
                kind, opener, previous = (REST if depth else WHOLE), "", None
            if previous is not None:
                quoted, depth = _brace(quoted, depth)
                parts.append("}")
                if not depth and not quoted:
                    close("", FAULT)  # a brace never ends the list
            previous = piece
            masked = ESCAPED.sub("__", piece)
            start = at = 0
            if quoted:
                at = masked.find('"') + 1
                quoted = at == 0
            for m in MARKS.finditer(masked, at) if not quoted else ():
                mark, spot = m[0], m.start()
                if mark == '"':  # the string goes on behind the piece
                    quoted = True
                    break
                if mark in "[{":
                    depth += 1
                    if depth == 1:
                        if "".join(parts).strip("﻿ \t\r\n") or piece[start:spot].strip("﻿ \t\r\n") or mark == "{":
                            close("", FAULT)
                        parts, start, opener = [], spot + 1, "["
                elif mark in "]}":
                    depth -= 1
                    if depth == 0:
                        close(piece[start:spot], mark if mark == "]" else FAULT)
                        start = spot + 1
                    elif depth < 0:
                        close("", FAULT)
                elif mark == "," and depth == 1:
                    close(piece[start:spot], ",")
                    start, opener = spot + 1, ","
            parts.append(piece[start:])
            if len(out) >= ROWS or sum(len(r[-1]) for r in out[-64:]) > CHARS:
                yield flush()
                out = []
        if out:
            yield flush()
            out = []
    if here:
        end()
    if out:
        yield flush()


def _brace(quoted: bool, depth: int) -> tuple[bool, int]:
    return quoted, depth if quoted else depth - 1


def list_splits(spark: SparkSession, path: str, files: Files) -> DataFrame:
    """One row per split of the files: what it does to the state, stored by the caller."""
    return _pieces(spark, path, files).select("value", "_file", "_block").mapInArrow(
        _split_functions, "_file string, _block bigint, turns int, outside bigint, inside bigint, opens string"
    )


def _pieces(spark: SparkSession, path: str, files: Files) -> DataFrame:
    return scan_in_order(spark, spark.read.option("lineSep", "}").text(path), files)


def list_elements(spark: SparkSession, path: str, splits: DataFrame, files: Files) -> DataFrame:
    """``element`` and the order columns for every element of the lists; a bad file fails the job."""
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    quoted = F.pmod(F.coalesce(F.sum("turns").over(before), F.lit(0)), F.lit(2)) == 1
    states = splits.withColumn("quoted", quoted).withColumn("deeper", F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside")))
    states = states.select(
        "_file",
        "_block",
        "quoted",
        F.coalesce(F.sum("deeper").over(before), F.lit(0)).cast("int").alias("depth"),
        (F.col("_block") == F.max("_block").over(whole)).alias("last"),
    )
    # One row per split: 100 TB are fewer than a million.
    marked = _pieces(spark, path, files).join(F.broadcast(states), ["_file", "_block"])
    cut = marked.select("value", "_file", "_block", "quoted", "depth", "last").mapInArrow(
        _elements, "_file string, _block bigint, _place bigint, kind int, opener string, closer string, element string"
    )
    done = cut.filter(F.col("kind") == WHOLE).drop("kind")
    order = Window.partitionBy("_file").orderBy("_block", F.col("kind").desc())
    parts = cut.filter(F.col("kind") != WHOLE).withColumn("nth", F.sum((F.col("kind") == HEAD).cast("int")).over(order))
    spot = [F.col("_block"), (F.lit(-1) * F.col("kind")).alias("k")]
    joined = parts.groupBy("_file", "nth").agg(
        F.min(F.struct(*spot, "_place", "opener")).alias("first"),
        F.max(F.struct(*spot, "closer")).alias("end"),
        F.array_sort(F.collect_list(F.struct(*spot, "element"))).alias("parts"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["element"]), "")
    mended = joined.select(
        "_file", *[F.col(f"first.{c}").alias(c) for c in ("_block", "_place", "opener")], F.col("end.closer").alias("closer"), text.alias("element")
    )
    every = done.unionByName(mended)
    empty = is_blank("element")
    alone = empty & (F.col("opener") == "[") & (F.col("closer") == "]")  # a list without elements
    fault = ~F.col("closer").isin(",", "]") | (empty & ~alone)
    told = F.concat(F.col("_file"), F.lit(" is not valid JSON"))
    good = F.when(fault, F.raise_error(told).cast("boolean")).otherwise(~alone)
    return every.filter(good).select("_file", "_block", "_place", "element")
