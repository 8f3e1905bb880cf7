"""The ``seq`` order key of file sources.

Order carries meaning here (first occurrence wins), so each record gets a number that
rises in file order: the running byte at which the record's file split starts (files taken
in path order) and, below it, the record's place in its scan task.  A byte starts one split
only, so numbers are unique however Spark cuts the files.  That needs one narrow pass and no
shuffle, and gives the same number again when a lost task is run anew.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

PLACE_BITS = 33  # rows of one scan task, as in monotonically_increasing_id
BROADCAST_FILES = 100_000
SMALL_FILE = 1 << 20  # bytes of a file that shares a task with others
FILES_OF_TASK = 256  # such files of a task, about
PLAIN = r"\.(json|jsonl|ndjson|txt)$"
ORDER = "decimal(38,0)"

ORDER_COLUMNS = ["_file", "_block", "_place"]


def with_order_columns(scan: DataFrame) -> DataFrame:
    """Add file, first byte of the split and place; must sit directly on the file scan."""
    place_mask = F.lit((1 << PLACE_BITS) - 1)
    return scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().bitwiseAND(place_mask).alias("_place"),
    )


@dataclass
class Files:
    """The files of a source: ``starts`` is ``_file, _size, _first``, the last being the running
    byte at which the file starts; ``scan`` reads them as binary files."""

    scan: DataFrame
    starts: DataFrame
    count: int
    largest: int
    total: int
    small: int  # files of up to SMALL_FILE bytes
    small_bytes: int
    plain: int  # files whose names say that they are not compressed

    @property
    def many(self) -> bool:
        return self.small > FILES_OF_TASK


def list_files(spark: SparkSession, path) -> Files:
    """No content is read.  One row per file: the running sum is one small task."""
    scan = spark.read.format("binaryFile").load(path)
    files = scan.select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")
    )
    files = files.coalesce(_few_tasks(spark))
    before = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, 0)
    starts = files.withColumn("_first", F.sum(F.col("_size") + 1).over(before) - F.col("_size") - 1)
    small = F.when(F.col("_size") <= SMALL_FILE, F.col("_size"))
    plain = F.count_if(F.col("_file").rlike(PLAIN))
    found = files.agg(F.count(F.lit(1)), F.max("_size"), F.sum("_size"), F.count(small), F.sum(small), plain).first()
    return Files(scan, starts, *[n or 0 for n in found])


def _few_tasks(spark: SparkSession) -> int:
    return 2 * spark.sparkContext.defaultParallelism


def scan_in_order(spark: SparkSession, scan: DataFrame, files: Files) -> DataFrame:
    """The file scan with its order columns; many small files are read by few tasks.

    Spark counts the opening of a file as bytes, 4 MB of them, so its tasks would read a
    handful of small files each.  Large files are cut and dealt out as ever.
    """
    if not files.many:
        return with_order_columns(scan)
    task_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    tasks = max(-(-files.small // FILES_OF_TASK), -(-files.small_bytes // task_bytes), _few_tasks(spark))
    if files.small == files.count:
        return with_order_columns(scan).coalesce(tasks)
    small = F.col("_metadata.file_size") <= SMALL_FILE
    few = with_order_columns(scan.filter(small)).coalesce(tasks)
    return few.unionByName(with_order_columns(scan.filter(~small)))


def _pack(first: Column) -> Column:
    """(first byte, place) as one number."""
    scale = F.lit(1 << PLACE_BITS).cast("decimal(12,0)")
    return (first.cast("decimal(20,0)") * scale + F.col("_place").cast("decimal(12,0)")).cast(ORDER)


def with_seq(
    spark: SparkSession, path, scan: DataFrame, *, whole_files: bool = False, files: Files | None = None
) -> DataFrame:
    """Turn the order columns into ``seq``; ``_file`` stays as ``source``.

    ``whole_files`` says Spark reads each file in one task: the records of large files
    are then spread, so that what follows is not done by those few tasks.
    """
    files = files or list_files(spark, path)
    if files.count <= 1:
        numbered = scan.withColumn("seq", _pack(F.col("_block")))
    else:
        starts = files.starts.select("_file", "_first")
        if files.count <= BROADCAST_FILES:
            starts = F.broadcast(starts)
        numbered = scan.join(starts, "_file").withColumn("seq", _pack(F.col("_first") + F.col("_block")))
    task_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    if whole_files and files.largest > task_bytes:
        numbered = numbered.repartition(-(-files.total // task_bytes), "seq")
    others = [c for c in scan.columns if c not in ORDER_COLUMNS]
    return numbered.select("seq", F.col("_file").alias("source"), *[F.col(f"`{c}`") for c in others])


def _bytes(setting: str) -> int:
    number = setting.lower().rstrip("b")
    scale = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:], 0)
    return int(number[:-1] if scale else number) << scale
