"""One file per row: folders of many small documents."""

from __future__ import annotations

import os
import shutil
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

# What runs in Python workers travels by value: executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_documents(df: DataFrame, path: str) -> None:
    """Every ``value`` as a line or lines of a file of its own, in a folder per task.

    Where ``path`` is in a mounted folder, Hadoop without its native library starts a process
    for the mode of each file it makes, which takes longer than all else.  Tasks write there
    themselves, and a folder gets its name when it is whole.  Other stores are Spark's to write.
    """
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() != "file":
        files = df.select("value", F.spark_partition_id().alias("part"))
        files.write.partitionBy("part").option("maxRecordsPerFile", 1).text(path)
        return
    if store.exists(folder):
        raise FileExistsError(path)
    store.mkdirs(folder)
    lines = df.select(F.coalesce(F.col("value"), F.lit("")).cast("binary").alias("value"))
    written = lines.mapInArrow(_writer(folder.toUri().getPath()), "files bigint")
    written.write.format("noop").mode("overwrite").save()


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, count = TaskContext.get(), 0
        # Readers pass over names that begin so: an attempt that fails leaves no documents.
        attempt = f"{folder}/_{task.partitionId()}-{task.taskAttemptId()}"
        for batch in batches:
            if batch.num_rows:
                os.makedirs(attempt, exist_ok=True)
            for value in batch.column(0):
                with open(f"{attempt}/{count}.json", "wb") as file:
                    file.write(value.as_py() + b"\n")
                count += 1
        if count:
            try:
                os.rename(attempt, f"{folder}/part={task.partitionId()}")
            except OSError:
                if not os.path.isdir(f"{folder}/part={task.partitionId()}"):
                    raise
                shutil.rmtree(attempt)  # another attempt of the task was first
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], names=["files"])

    return write
