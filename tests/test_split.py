import pytest
from pyspark.sql import functions as F

from tallyforge.functions.recode import key_number
from tallyforge.operators.split import (
    fold_number,
    hash_split,
    in_training,
    part_number,
    random_split,
    training_flag,
    with_row_key,
)

from tests.conftest import tuples


def keyed(spark, n=20_000):
    return spark.range(n).selectExpr("concat('row-', id) as k")


def test_hash_split_is_complete_disjoint_and_stable(spark):
    df = keyed(spark)
    train, test = hash_split(df, "k")
    again, _ = hash_split(df.repartition(13), "k")
    assert train.intersect(test).count() == 0
    assert train.count() + test.count() == 20_000
    assert abs(train.count() / 20_000 - 0.7) < 0.02
    assert train.exceptAll(again).count() == 0


def test_hash_split_needs_no_shuffle(spark):
    train, _ = hash_split(keyed(spark), "k")
    assert "Exchange" not in train._jdf.queryExecution().executedPlan().toString()


def test_copies_of_a_key_stay_together(spark):
    df = spark.createDataFrame([("same",)] * 50, "k string")
    assert df.select(in_training("k")).distinct().count() == 1


def test_folds_cover_the_range(spark):
    folds = tuples(keyed(spark).groupBy(fold_number("k", 4).alias("f")).agg(F.count("*")))
    assert sorted(f for f, _ in folds) == [0, 1, 2, 3]
    assert all(abs(n / 20_000 - 0.25) < 0.02 for _, n in folds)


def test_random_split_adds_up(spark):
    train, test = random_split(keyed(spark), seed=1)
    assert train.count() + test.count() == 20_000
    assert train.intersect(test).count() == 0
    again, _ = random_split(keyed(spark), seed=1)
    assert train.exceptAll(again).count() == 0


def test_coin_toss_flag(spark):
    df = keyed(spark)
    flags = df.select("k", training_flag("k", toss_seed=5).alias("t"))
    share = flags.filter("t").count() / 20_000
    assert abs(share - 0.7) < 0.02
    again = df.select("k", training_flag("k", toss_seed=5).alias("t"))
    assert flags.exceptAll(again).count() == 0
    other = df.select("k", training_flag("k", toss_seed=6).alias("t"))
    assert flags.exceptAll(other).count() > 0


@pytest.mark.parametrize("folds", [4, 10, 50, 100])
def test_folds_of_training_rows_are_even(spark, folds):
    """Folds do not follow the split: within the training part none is empty or crowded."""
    train = keyed(spark).where(in_training("k"))
    sizes = [n for _, n in tuples(train.groupBy(fold_number("k", folds)).agg(F.count("*")))]
    mean = 14_000 / folds
    assert len(sizes) == folds
    assert all(abs(n - mean) < 6 * mean**0.5 for n in sizes)


@pytest.mark.parametrize("share", [0.705, 0.5, 0.0, 1.0, 0.99995])
def test_shares_are_not_rounded(spark, share):
    n = keyed(spark, 200_000).where(in_training("k", share)).count()
    assert abs(n - 200_000 * share) <= 5 * (200_000 * share * (1 - share)) ** 0.5


def test_toss_is_the_same_under_any_partitioning(spark):
    df = keyed(spark)
    four = df.repartition(4).withColumn("t", training_flag("k", toss_seed=1))
    seven = df.repartition(7, "k").withColumn("t", training_flag("k", toss_seed=1))
    assert four.exceptAll(seven).count() == 0
    split = df.withColumn("t", in_training("k"))
    assert four.exceptAll(split).count() > 0


def test_null_parts_of_keys_are_told_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), (None, None)], "x string, y string")
    numbers = {r[0] for r in df.select(key_number(["x", "y"])).collect()}
    assert len(numbers) == 4


def test_rows_without_a_key_get_one_from_their_content(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a")], "row_key int, y string")
    keyed_rows, name = with_row_key(df, None)
    assert name == "row_key_" and keyed_rows.select(name).distinct().count() == 3
    assert with_row_key(df, "y") == (df, "y")


def test_weighted_parts(spark):
    df = keyed(spark).withColumn("part", part_number("k", (0.6, 0.2, 0.2)))
    shares = {p: n / 20_000 for p, n in tuples(df.groupBy("part").count())}
    assert set(shares) == {0, 1, 2}
    assert all(abs(shares[p] - w) < 0.02 for p, w in enumerate((0.6, 0.2, 0.2)))
    assert df.where(in_training("k", 0.6) != (F.col("part") == 0)).count() == 0
    parts = hash_split(keyed(spark).repartition(7), "k", weights=(0.6, 0.2, 0.2))
    assert [p.count() for p in parts] == [df.where(f"part = {i}").count() for i in range(3)]
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_parts_of_any_weights(spark):
    df = keyed(spark)
    scaled = df.select(part_number("k", (3, 1, 1)).alias("a"), part_number("k", (0.6, 0.2, 0.2)).alias("b"))
    assert scaled.where("a <> b").count() == 0
    counted = dict(tuples(df.groupBy(part_number("k", (1, 0, 1, 0)).alias("p")).count()))
    assert set(counted) == {0, 2} and abs(counted[0] - 10_000) < 400
    thirds = dict(tuples(df.groupBy(part_number("k", (1, 1, 1)).alias("p")).count()))
    assert set(thirds) == {0, 1, 2} and all(abs(n - 6667) < 300 for n in thirds.values())
    assert tuples(df.select(part_number("k", (5,)).alias("p")).distinct()) == [(0,)]
    for wrong in ((), (0, 0), (1, -1), (float("inf"),)):
        with pytest.raises(ValueError):
            part_number("k", wrong)
