"""Facts held in the text of answers and questions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatprep.functions.text import WS, strip

# Where a name, a feature, a link and a category stand in the text.
NAME = r"「([^」]+)」"
FEATURE = r"特徴：([^）\n]+)"
URL = f"https?://[^{WS}]+"
CATEGORIES = [
    r"おすすめの([^\n]+?)のお店",
    r"神戸で([^\n]+?)を食べるなら",
    r"([^\n]+?)が食べたい",
    r"人気の([^\n]+?)のお店",
]


def has_name(answer) -> Column:
    return F.regexp_like(answer, F.lit(NAME))


def fact_name(answer) -> Column:
    return strip(F.regexp_extract(answer, NAME, 1))


def fact_feature(answer) -> Column:
    return strip(F.regexp_extract(answer, FEATURE, 1))


def fact_url(answer) -> Column:
    return strip(F.regexp_extract(answer, URL, 0))


def category(question) -> Column:
    """The first pattern that matches decides, even when its text is blank."""
    chain = F
    for pattern in CATEGORIES:
        chain = chain.when(
            F.regexp_like(question, F.lit(pattern)), strip(F.regexp_extract(question, pattern, 1))
        )
    return chain.otherwise(F.lit(""))
