"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatprep import staging
from chatprep.staging import release, staged_tables  # noqa: F401  (operators take them from here)

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Store the table in the shared folder and go on from there.

    The shuffle files behind a stored table are of no more use, so Spark is told to remove
    them as soon as it is written.
    """
    spark = df.sparkSession
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        return staging.stage(df, name)
    finally:
        spark.conf.set(setting, before) if before is not None else spark.conf.unset(setting)


BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it is counted to have no more rows than the limit."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Words between runs of separators, none empty; no words for null."""
    parts = F.split(F.coalesce(text, F.lit("")), separators)
    return F.filter(parts, lambda w: w != "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have yet, whatever the letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def group_key(column: Column) -> Column:
    """A text that is never null and differs between null and every value."""
    return F.when(column.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), column.cast("string")))


def seeded_hash(seed: int, *columns: Column) -> Column:
    """52 bits, evenly spread, of the seed and the columns: the same in every run."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def is_held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls in the part kept for measuring; null ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
