"""Exact, repeatable training/validation split."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

DIGIT_BITS = 16


class Split(NamedTuple):
    """Both sides carry ``_shuffle``, the first half of their order key (then ``seq``)."""

    train: DataFrame
    valid: DataFrame


def shuffle_key(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("seq"))


def _digit(level: int) -> Column:
    """16 bits of the key from the top, in key order."""
    shift = 64 - DIGIT_BITS * (level + 1)
    # Flipping the sign bit makes signed order and bit order agree.
    bits = F.col("_shuffle").bitwiseXOR(F.lit(-(1 << 63)))
    return F.shiftrightunsigned(bits, shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))


def _last_valid(keyed: DataFrame, wanted: int, small: int) -> tuple[int, int]:
    """Order key of the ``wanted``-th row: counts per digit, then one small sort.

    The driver sees at most 65,536 counts per level and one row; two levels leave a
    handful of rows even at 10**12.
    """
    rest = keyed.select("_shuffle", "seq")
    for level in range(64 // DIGIT_BITS):
        counts = sorted(rest.groupBy(_digit(level).alias("d")).count().collect())
        for digit, count in counts:
            if wanted <= count:
                break
            wanted -= count
        rest = rest.filter(_digit(level) == digit)
        if count <= small:
            break
    ordered = rest.orderBy("_shuffle", "seq").limit(wanted)
    row = ordered.agg(F.max(F.struct("_shuffle", "seq")).alias("last")).first()["last"]
    return row["_shuffle"], row["seq"]


def split_train_valid(
    kept: DataFrame, valid_frac: float = 0.1, seed: int = 3407, *, small: int = 10_000
) -> Split:
    """Hold out exactly ``max(1, round(n * valid_frac))`` rows, at most ``n - 1``.

    Rows are ordered by a seeded hash of ``seq``; the cut is a plain filter on that
    key, so neither side is shuffled or sorted here.  With fewer than two rows both
    sides hold them all.
    """
    keyed = kept.withColumn("_shuffle", shuffle_key(seed))
    n = kept.count()
    if n < 2:
        return Split(keyed, keyed)
    wanted = min(max(1, round(n * valid_frac)), n - 1)
    last_key, last_seq = _last_valid(keyed, wanted, small)
    in_valid = (F.col("_shuffle") < last_key) | (
        (F.col("_shuffle") == last_key) & (F.col("seq") <= last_seq)
    )
    return Split(keyed.filter(~in_valid), keyed.filter(in_valid))
