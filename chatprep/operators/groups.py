"""Groups and keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Characters that a cell of the engine can hold: 2 GB, at up to four bytes a character.
CELL_CHARS = 1 << 29

# A key with more than 1/HOT_SHARE of all rows is spread over several join keys; there
# are fewer than HOT_SHARE such keys.
HOT_SHARE = 10_000


def in_one_cell(value: Column, chars: Column, key: Column) -> Column:
    """The assembled value; the job fails with the key and size where no cell can hold it."""
    told = F.concat(
        F.lit("group "),
        F.coalesce(key.cast("string"), F.lit("null")),
        F.lit(" has "),
        chars.cast("string"),
        F.lit(" characters, more than a cell can hold"),
    )
    return F.when(F.coalesce(chars, F.lit(0)) > CELL_CHARS, F.raise_error(told)).otherwise(value)


def hot_keys(counts: DataFrame, key: str, count: str, share: int = HOT_SHARE) -> DataFrame:
    """``key, _salts`` of the keys above their share: enough salts to bring each below."""
    limit = F.broadcast(counts.agg((F.sum(count) / share).alias("_limit")))  # one row
    return (
        counts.crossJoin(limit)
        .filter(F.col(count) > F.col("_limit"))
        .select(key, F.ceil(F.col(count) / F.col("_limit")).cast("int").alias("_salts"))
    )


def salted_join(
    many: DataFrame, few: DataFrame, key: str, spread_by: str, hot: DataFrame
) -> DataFrame:
    """Inner join in which the ``many`` rows of a hot key meet copies of its ``few`` rows
    in several tasks.  ``hot`` comes from ``hot_keys``: fewer than HOT_SHARE rows."""

    def with_salts(side):
        joined = side.join(F.broadcast(hot), key, "left")
        return joined.withColumn("_salts", F.coalesce("_salts", F.lit(1)))

    salt = F.pmod(F.xxhash64(spread_by), "_salts").cast("int")
    left = with_salts(many).withColumn("_salt", salt).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    right = with_salts(few).withColumn("_salt", copies).drop("_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")
