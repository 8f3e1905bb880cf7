"""Text rules shared by all operators, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The 29 code points that count as white space, as a plain string
# (for trimming) and as the body of a regular-expression class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text) -> Column:
    """Remove white space of any kind at both ends (``trim`` knows only U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def clean(text) -> Column:
    """Stripped text, ``''`` for null."""
    return strip(F.coalesce(text, F.lit("")))


def is_blank(text) -> Column:
    return clean(text) == ""


def fold(text) -> Column:
    """The form used for matching: stripped and lower-cased."""
    return F.lower(clean(text))


def drop_whitespace(text) -> Column:
    return F.regexp_replace(text, f"[{WS}]+", "")


def token_estimate(text: Column) -> Column:
    """One token per four ASCII characters (rounded down) and one per other character."""
    chars = F.length(text)
    # Equal byte and character counts mean pure ASCII: no need to run the regex.
    wide = F.when(F.octet_length(text) == chars, F.lit(0)).otherwise(
        F.length(F.regexp_replace(text, r"[\x00-\x7F]+", ""))
    )
    return (F.floor((chars - wide) / F.lit(4)) + wide).cast("bigint")
