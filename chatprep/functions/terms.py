"""Words and character n-grams of a text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# What counts as a word, and the n-gram lengths.
WORD = "[a-z0-9]+|[ぁ-んァ-ン一-龥ー]+"
GRAM_LENGTHS = (2, 3)

# Characters of a text whose n-grams are listed together.
PIECE = 65_536

POINT_BYTES = 4


def words(folded) -> Column:
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


def code_points(text) -> Column:
    """Fixed-width form: any run of characters is a byte slice, found without a scan."""
    return F.encode(text, "UTF-32")


def from_code_points(points) -> Column:
    return F.decode(points, "UTF-32")


def point_count(points) -> Column:
    return (F.octet_length(points) / POINT_BYTES).cast("int")


def point_slice(points: Column, start: Column, length: int) -> Column:
    return F.substring(points, start * POINT_BYTES + 1, length * POINT_BYTES)
