"""Seeded and key-based splits."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots a hashed key can fall into; a split's weights are exact to one in this many.
_SLOTS = 1 << 30


def random_split(df: DataFrame, weights: Sequence[float], seed: int) -> list[DataFrame]:
    """Spark's seeded split.  The parts depend on how ``df`` is partitioned; prefer `hash_split`."""
    return df.randomSplit(list(weights), seed)


def slot(key: str | Column | Sequence[str], slots: int, seed: int | None = None) -> Column:
    """A number in 0..slots-1 that depends only on the key.

    Without a seed the key itself is taken modulo ``slots`` (dense integer keys);
    with one, a hash of the key and the seed.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    columns = [F.col(k) if isinstance(k, str) else k for k in keys]
    number = columns[0] if seed is None else F.xxhash64(*columns, F.lit(seed))
    return F.pmod(number, F.lit(slots)).cast("int")


def is_train(key: str | Column | Sequence[str], ratio: float = 0.8, seed: int | None = None) -> Column:
    """True for about ``ratio`` of the keys, the same ones after any repartitioning."""
    if seed is not None:
        return slot(key, _SLOTS, seed) < round(ratio * _SLOTS)
    share = Fraction(str(ratio)).limit_denominator(10_000)
    if share in (0, 1) and 0 < ratio < 1:  # no part may vanish
        share = Fraction(str(ratio)).limit_denominator(_SLOTS)
        if share in (0, 1):
            raise ValueError(f"the ratio {ratio} leaves one part without keys")
    return slot(key, share.denominator) < share.numerator


def hash_split(
    df: DataFrame, key: str | Sequence[str], ratio: float = 0.8, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by key; a narrow filter, no shuffle."""
    train = is_train(key, ratio, seed)
    return df.where(train), df.where(~train)


def with_fold(
    df: DataFrame, key: str | Sequence[str], folds: int, seed: int | None = None, output: str = "fold"
) -> DataFrame:
    """The fold number of each row, by key."""
    return df.select("*", slot(key, folds, seed).alias(output))
