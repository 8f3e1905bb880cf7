"""Tables stored half way through a job.

A stored table cuts the lineage: a lost executor costs the running tasks, not the work
before.  It lives in the shared folder named by ``spark.checkpoint.dir``, until it is
released, or until the block of ``staged_tables`` around it ends.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def staging_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="chatprep-")  # one machine only: tests and samples
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Tables:
    """What is staged inside a block."""

    def __init__(self, outer: Tables | None):
        self._outer = outer
        self._paths: dict[str, SparkSession] = {}

    def add(self, path: str, spark: SparkSession) -> None:
        self._paths[path] = spark

    def keep(self, table: DataFrame) -> DataFrame:
        """Let a staged table outlive the block; the block around it, if any, takes it over."""
        path = _PATHS[table]
        spark = self._paths.pop(path)
        if self._outer is not None:
            self._outer.add(path, spark)
        return table

    def delete(self) -> None:
        for path, spark in self._paths.items():
            _delete(spark, path)
        self._paths.clear()


_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_OPEN: ContextVar[Tables | None] = ContextVar("staged", default=None)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write the table once and go on from the stored copy."""
    spark = df.sparkSession
    path = f"{staging_folder(spark)}/{name}-{uuid4().hex}"
    if (tables := _OPEN.get()) is not None:
        tables.add(path, spark)
    df.write.parquet(path)
    table = spark.read.parquet(path)
    _PATHS[table] = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete staged tables.  Call it when all that is read from them has been stored."""
    for table in tables:
        _delete(table.sparkSession, _PATHS.pop(table))


@contextmanager
def staged_tables() -> Iterator[Tables]:
    """Tables staged inside the block are deleted at its end, also when it fails.

    Jobs such as ``search`` return plans that read staged tables: write or collect their
    results inside the block.
    """
    tables = Tables(_OPEN.get())
    token = _OPEN.set(tables)
    try:
        yield tables
    finally:
        _OPEN.reset(token)
        tables.delete()
