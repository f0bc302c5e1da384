"""Splitting a table into training and test parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyforge.functions.recode import NULL_PART, hash_bucket, key_number

# Fixed value: share of the rows the studies train on.
TRAIN_SHARE = 0.7


def random_split(
    df: DataFrame, weights: Sequence[float] = (TRAIN_SHARE, 1 - TRAIN_SHARE), seed: int | None = None
) -> list[DataFrame]:
    """Independent coin tosses per row; even with a seed the result follows the partitioning."""
    return df.randomSplit(list(weights), seed)


# Buckets beyond this number would not be equally likely.
MAX_BUCKETS = 10**6


def _buckets(share: float) -> int | None:
    """The fewest buckets, 100 or more, of which ``share`` is a whole number, if there are few enough."""
    buckets = 100
    while round(share * buckets, 9) != round(share * buckets):
        buckets *= 10
        if buckets > MAX_BUCKETS:
            return None
    return buckets


def _number_and_ends(key: str | Sequence[str], shares: Sequence[float]) -> tuple[Column, list[int]]:
    """A number that depends only on the key, and below which number each share of the keys lies."""
    buckets = [_buckets(share) for share in shares]
    if None in buckets:
        return key_number(key), [round(share * 2**32) for share in shares]
    return hash_bucket(key, max(buckets)), [round(share * max(buckets)) for share in shares]


def in_training(key: str | Sequence[str], share: float = TRAIN_SHARE) -> Column:
    """True for the rows of the training part, decided by the row's key alone."""
    number, ends = _number_and_ends(key, [share])
    return number < F.lit(ends[0])


def training_flag(
    key: str | Sequence[str], share: float = TRAIN_SHARE, toss_seed: int | None = None
) -> Column:
    """Marks training rows: by key, or with a seed by a toss per key.

    The toss depends on seed and key only, so it falls the same on every recomputation and under
    any partitioning. It picks other rows than :func:`random_split` would.
    """
    if toss_seed is None:
        return in_training(key, share)
    return key_number(key, salt=f"toss {toss_seed}") < F.lit(round(share * 2**32))


def part_number(key: str | Sequence[str], weights: Sequence[float]) -> Column:
    """Which of several parts a row is in, from 0, decided by the row's key alone.

    Parts get shares of the keys in proportion to their ``weights``; a part of weight zero gets none.
    Weights that add up to 1, such as 0.6, 0.2 and 0.2, divide the same buckets as :func:`in_training`.
    """
    total = sum(weights)
    if not weights or min(weights) < 0 or not 0 < total < float("inf"):
        raise ValueError("weights are numbers of 0 or more, not all 0")
    number, ends = _number_and_ends(key, [sum(weights[: i + 1]) / total for i in range(len(weights))])
    last = max(i for i, weight in enumerate(weights) if weight > 0)
    part = F.lit(last)
    for i in reversed(range(last)):
        part = F.when(number < F.lit(ends[i]), F.lit(i)).otherwise(part)
    return part.cast("int")


def hash_split(
    df: DataFrame,
    key: str | Sequence[str],
    share: float = TRAIN_SHARE,
    weights: Sequence[float] | None = None,
) -> tuple[DataFrame, ...]:
    """Parts of a table by key: the same rows whatever the partitioning, and no shuffle.

    Training and test rows by ``share``, or as many parts as there are ``weights``. To use all parts at
    once, add :func:`in_training` or :func:`part_number` as a column, which scans the input once.
    """
    if weights is not None:
        part = part_number(key, weights)
        return tuple(df.filter(part == i) for i in range(len(weights)))
    rule = in_training(key, share)
    return df.filter(rule), df.filter(~rule)


def fold_number(key: str | Sequence[str], folds: int) -> Column:
    """Cross-validation fold of a row, decided by its key alone and independent of the split."""
    return hash_bucket(key, folds, part=1)


def with_row_key(df: DataFrame, key: str | None, name: str = "row_key") -> tuple[DataFrame, str]:
    """``df`` and its key column; without one, a digest of all columns (copies share it)."""
    if key is not None:
        return df, key
    while name in df.columns:
        name += "_"
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_PART)) for c in df.columns]
    return df.withColumn(name, F.md5(F.concat_ws("|", *texts))), name
