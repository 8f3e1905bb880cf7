"""File readers: CSV, JSON documents and JSON Lines to record tables."""

from __future__ import annotations

import re
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chatprep.functions.text import is_blank, strip
from chatprep.operators.normalize import (
    normalize_conversations,
    prepare_session,
    resolve_columns,
)
from chatprep.operators.quality import drop_blank_pairs
from chatprep.sources.json_lists import list_elements, list_splits
from chatprep.sources.order import (
    ORDER_COLUMNS,
    SMALL_FILE,
    Files,
    list_files,
    scan_in_order,
    with_order_columns,
    with_seq,
)
from chatprep.sources.quoted import csv_records
from chatprep.staging import stage


def _csv_reader(spark: SparkSession, multi_line: bool):
    return spark.read.options(
        multiLine=multi_line, quote='"', escape='"', encoding="UTF-8", mode="PERMISSIVE"
    )


def read_csv_records(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Header CSV to ``seq, source, <columns>``, all text.

    Large files are read by many tasks, also where cells hold line breaks;
    ``multi_line=False`` says that none does, and saves a pass.  Of columns whose names
    differ only in case the last one is kept.  Files of a folder must have the same header.
    """
    header = _csv_reader(spark, multi_line).csv(path, header=False).first()
    if header is None:
        raise ValueError(f"{path}: CSV has no header row")
    names = ["" if name is None else name for name in header]
    last = {name.lower(): i for i, name in enumerate(names)}
    # Repeated and empty names can only be read by position.
    compared = len(last) == len(names) and "" not in names
    if multi_line and not _lone_returns(spark, path):
        read, whole_files = _quoted_csv(spark, path, names if compared else None, len(names)), False
    else:
        # With different names Spark compares the header of every file and fails where one differs.
        fields = names if compared else [f"_c{i}" for i in range(len(names))]
        schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
        reader = _csv_reader(spark, multi_line).option("enforceSchema", not compared).schema(schema)
        read, whole_files = with_order_columns(reader.csv(path, header=True)), multi_line
    scan = read.toDF(*[f"_c{i}" for i in range(len(names))], *ORDER_COLUMNS)
    numbered = with_seq(spark, path, scan, whole_files=whole_files)
    kept = [
        F.col(f"_c{i}").alias(names[i])
        for name, i in last.items()
        if name not in ("seq", "source")  # our own columns; no role goes by these names
    ]
    return numbered.select("seq", "source", *kept)


def _lone_returns(spark: SparkSession, path: str) -> bool:
    """Do carriage returns alone end the lines?  Such files are read whole, a task each."""
    first = spark.read.option("lineSep", "\n").text(path).first()
    return first is not None and "\r" in re.sub('"[^"]*"?', "", first["value"]).rstrip("\r")


def _quoted_csv(spark: SparkSession, path: str, header: list[str] | None, width: int) -> DataFrame:
    """The cells of every record behind the header, as columns, and the order columns."""
    records = csv_records(spark, path)
    record = F.when(F.col("head"), F.regexp_replace("record", "^\ufeff", "")).otherwise(F.col("record"))
    # One cell more than the header has tells a header that is longer.
    schema = ", ".join(f"_c{i} string" for i in range(width + 1))
    cells = F.from_csv(record, schema, {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"})
    parsed = records.select(cells.alias("_cells"), "head", *ORDER_COLUMNS)
    if header is not None:
        expected = F.col(f"_cells._c{width}").isNull()
        for i, name in enumerate(header):
            expected &= F.col(f"_cells._c{i}").eqNullSafe(F.lit(name))
        told = F.concat(F.col("_file"), F.lit(": the header differs from that of other files"))
        keep = F.when(~F.col("head"), F.lit(True)).when(expected, F.lit(False)).otherwise(F.raise_error(told).cast("boolean"))
    else:
        keep = ~F.col("head")
    return parsed.filter(keep).select(*[F.col(f"_cells._c{i}") for i in range(width)], *ORDER_COLUMNS)


def is_json_value(text: Column) -> Column:
    """Is the text exactly one JSON value?

    Spark's parser stops after the first value, so the text is also tried inside a list
    and inside an object: whatever follows the value breaks one of the two.
    """
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    in_list = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    in_object = F.from_json(
        F.concat(F.lit('{"value":'), text, F.lit("}")), "struct<value:string>", strict
    )
    one = F.coalesce(F.size(in_list), F.lit(0)) == 1
    return one & (in_object["value"].isNotNull() | (strip(text) == "null"))


def _first_lines(spark: SparkSession, path: str) -> list[bool]:
    """Of the first two lines with text, whether each is a JSON value."""
    lines = spark.read.text(path).filter(~is_blank("value"))
    return [r["ok"] for r in lines.select(is_json_value(F.col("value")).alias("ok")).take(2)]


def _all_documents(spark: SparkSession, path: str) -> bool:
    """Is every file as a whole a JSON value?  For files that are no lists."""
    whole = spark.read.text(path, wholetext=True).filter(~is_blank("value"))
    return whole.filter(~is_json_value(strip(F.col("value")))).isEmpty()


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = with_order_columns(spark.read.text(path)).filter(~is_blank("value"))
    where = F.concat(
        F.lit("Line "),
        (F.col("_place") + 1).cast("string"),
        F.when(F.col("_block") > 0, F.concat(F.lit(" after byte "), F.col("_block").cast("string")))
        .otherwise(F.lit("")),
        F.lit(" of "),
        F.col("_file"),
        F.lit(" is not valid JSON"),
    )
    good = F.when(is_json_value(F.col("value")), F.lit(True)).otherwise(
        F.raise_error(where).cast("boolean")
    )
    return lines.filter(good).withColumnRenamed("value", "raw")


FAULT = re.compile(r"Line (\d+)(?: after byte (\d+))? of (\S+) is not valid JSON")


def line_in_file(spark: SparkSession, path: str, error: Exception) -> str | None:
    """The error of a bad line with its number in the file; None for other errors.

    The reader knows where in a file split the line is.  Only now that there is one, the
    lines before it are counted: those of the splits before and those of its own.
    """
    found = FAULT.search(str(error))
    if found is None:
        return None
    place, block, file = int(found[1]) - 1, int(found[2] or 0), found[3]
    lines = with_order_columns(spark.read.text(path))
    before = (F.col("_block") < block) | ((F.col("_block") == block) & (F.col("_place") <= place))
    number = lines.filter((F.col("_file") == file) & before).count()
    return f"Line {number} of {file} is not valid JSON"


def _read_lists(spark: SparkSession, path: str, splits: DataFrame, files: Files) -> DataFrame:
    """The elements of files that are lists, by many tasks."""
    elements = list_elements(spark, path, splits, files)
    told = F.concat(F.col("_file"), F.lit(" is not valid JSON"))
    text = strip(F.col("element"))
    good = F.when(is_json_value(text), F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    # Only objects are records; other elements stay as rows without usable text.
    raw = F.when(text.startswith("{"), text)
    return elements.filter(good).select("_file", "_block", "_place", raw.alias("raw"))


def _whole_files(spark: SparkSession, path: str, files: Files) -> DataFrame:
    """One ``value`` per file.  Of many files the driver holds one list only, a kilobyte each."""
    if files.many and files.plain == files.count:
        return files.scan.withColumn("value", F.col("content").cast("string")).drop("content")
    return spark.read.text(path, wholetext=True)


def _other_than_list(spark: SparkSession, whole: DataFrame, files: Files) -> bool:
    """Is one of many small files no list?  The first one found tells, without a pass over all."""
    if not files.many:
        return False  # unknown: the pass over all splits will tell
    size = F.col("_metadata.file_size")
    small = scan_in_order(spark, whole.filter((size > 0) & (size <= SMALL_FILE)), files)
    opens = F.substring(F.ltrim(F.concat("value", F.lit("}")), F.lit("\ufeff \t\r\n")), 1, 1)
    return not small.filter(opens != "[").isEmpty()


def _read_documents(spark: SparkSession, whole: DataFrame, files: Files) -> DataFrame:
    """Files of one value each, read whole."""
    whole = scan_in_order(spark, whole, files).filter(~is_blank("value"))
    text = strip(F.col("value"))
    items = F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(
        F.array(text)
    )
    kinds = F.when(text.startswith("["), F.from_json(text, "array<variant>")).otherwise(
        F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<variant>")
    )
    checked = F.when(is_json_value(text), items).otherwise(
        F.raise_error(F.concat(F.col("_file"), F.lit(" is not valid JSON"))).cast("array<string>")
    )
    parsed = whole.select("_file", "_block", checked.alias("_items"), kinds.alias("_kinds"))
    elements = parsed.select(
        "_file", "_block", F.posexplode(F.arrays_zip("_items", "_kinds")).alias("_place", "_e")
    )
    # Only objects are records; other elements stay as rows without usable text.
    is_object = F.schema_of_variant(F.col("_e._kinds")).startswith("OBJECT")
    return elements.select(
        "_file",
        "_block",
        F.col("_place").cast("bigint").alias("_place"),
        F.when(is_object, F.col("_e._items")).alias("raw"),
    )


def read_json_records(spark: SparkSession, path: str, *, layout: str = "auto") -> DataFrame:
    """JSON document, list of records or JSON Lines to ``seq, source, raw``.

    Lists and JSON Lines are read by many tasks; a file that is one object is one record.
    ``layout`` is ``auto``, ``document`` or ``lines``.  A folder with several files is
    taken as JSON Lines unless told otherwise.  A bad line fails the job that reads it
    and is named in the error.
    """
    prepare_session(spark)
    if layout not in ("auto", "document", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    # A first line that is a value, with another line after it, is one of JSON Lines.  A
    # first line that is none starts a document, or is a fault.
    first = _first_lines(spark, path) if layout == "auto" else []
    if layout == "lines" or (layout == "auto" and first[:1] != [False] and len(first) != 1):
        return with_seq(spark, path, _read_lines(spark, path))
    files = list_files(spark, path)
    whole = _whole_files(spark, path, files)
    if not _other_than_list(spark, whole, files):
        splits = stage(list_splits(spark, path, files), "list-splits")
        if splits.filter((F.col("_block") == 0) & (F.col("opens") != "[")).isEmpty():
            return with_seq(spark, path, _read_lists(spark, path, splits, files), files=files)
    if layout == "auto" and len(first) == 2 and not _all_documents(spark, path):
        return with_seq(spark, path, _read_lines(spark, path))
    return with_seq(spark, path, _read_documents(spark, whole, files), whole_files=True, files=files)


def is_json_path(path: str) -> bool:
    """By the file extension; an unknown one is an error."""
    extension = PurePosixPath(path).suffix.lower()
    if extension not in (".csv", ".jsonl", ".json", ".ndjson"):
        raise ValueError(f"Unknown file type {extension!r}. Use .csv, .jsonl, .json or .ndjson")
    return extension != ".csv"


def read_records(
    spark: SparkSession, path: str, *, multi_line: bool = True, layout: str = "auto"
) -> DataFrame:
    """Choose the reader by file extension; ``multi_line`` is for CSV, ``layout`` for JSON."""
    if is_json_path(path):
        return read_json_records(spark, path, layout=layout)
    return read_csv_records(spark, path, multi_line=multi_line)


def read_conversations(
    spark: SparkSession, path: str, default_system: str | None = None, **options
) -> DataFrame:
    """Records of a file as conversations; ``options`` as in ``read_records``."""
    records = read_records(spark, path, **options)
    return normalize_conversations(records, default_system, json=is_json_path(path))


def read_pairs(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Question/answer CSV to stripped ``seq, user, assistant``; blank sides are dropped."""
    records = resolve_columns(read_csv_records(spark, path, multi_line=multi_line))
    missing = {"user", "assistant"} - set(records.columns)
    if missing:
        raise ValueError(f"{path}: CSV needs user/assistant columns")
    return drop_blank_pairs(records.select("seq", "user", "assistant"))


def read_training_json(spark: SparkSession, path: str, *, layout: str = "auto") -> DataFrame:
    """A prepared JSON Lines file back as conversations."""
    return normalize_conversations(read_json_records(spark, path, layout=layout), json=True)
