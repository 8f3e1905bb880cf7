"""Text of one answer that stands for several."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from chatprep.functions.facts import fact_feature, fact_name, fact_url, has_name

# First lines and labels of a merged answer.
SHOPS_HEADER = "候補は複数あります。おすすめは次のお店です。"
ANSWERS_HEADER = "候補は複数あります。代表的な回答は次のとおりです。"
FEATURE_OPEN, FEATURE_CLOSE = "（特徴：", "）"
MAP_LINE = "\n   地図: "


def shop_line(number: Column, answer: Column) -> Column:
    feature, url = fact_feature(answer), fact_url(answer)
    return F.concat(
        number.cast("string"),
        F.lit(". "),
        fact_name(answer),
        F.when(feature == "", F.lit("")).otherwise(
            F.concat(F.lit(FEATURE_OPEN), feature, F.lit(FEATURE_CLOSE))
        ),
        F.when(url == "", F.lit("")).otherwise(F.concat(F.lit(MAP_LINE), url)),
    )


def answer_line(number: Column, answer: Column) -> Column:
    return F.concat(number.cast("string"), F.lit(". "), answer)


def merged_answer(answers: Column) -> Column:
    """Distinct answers in order to one text.

    The shop layout needs a name in every answer and no name twice.
    """
    names = F.transform(answers, fact_name)
    all_shops = F.forall(answers, has_name) & (F.size(F.array_distinct(names)) == F.size(answers))

    def listing(header, line):
        lines = F.transform(answers, lambda a, i: line(i + 1, a))
        return F.array_join(F.concat(F.array(F.lit(header)), lines), "\n")

    return F.when(all_shops, listing(SHOPS_HEADER, shop_line)).otherwise(
        listing(ANSWERS_HEADER, answer_line)
    )
