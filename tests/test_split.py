import pytest

from chatprep.operators.split import split_train_valid


def sides(split):
    return [{r["seq"] for r in side.collect()} for side in (split.train, split.valid)]


def rows(spark, n):
    return spark.range(n).withColumnRenamed("id", "seq")


@pytest.mark.parametrize(
    "n, frac, valid", [(25, 0.1, 2), (2, 0.9, 1), (4, 0.0, 1), (35, 0.1, 4), (1000, 0.37, 370)]
)
def test_sizes(spark, n, frac, valid):
    train, held = sides(split_train_valid(rows(spark, n), frac))
    assert len(held) == valid and train | held == set(range(n)) and not train & held


@pytest.mark.parametrize("n", [0, 1])
def test_too_small_to_split(spark, n):
    assert sides(split_train_valid(rows(spark, n))) == [set(range(n))] * 2


def test_same_cut_however_it_is_found(spark):
    data = rows(spark, 3000)
    one_sort = sides(split_train_valid(data, 0.2, small=10_000))
    by_digits = sides(split_train_valid(data.repartition(7), 0.2, small=1))
    assert one_sort == by_digits
    assert one_sort != sides(split_train_valid(data, 0.2, seed=1))
