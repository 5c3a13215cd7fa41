"""Holdout splits.

``hash_split`` is the default: a row is in the test side when a seeded mix of
(user, item) falls below the fraction. It is a pure function of the row, so a
recomputed partition (lost executor, re-read source) lands on the same side,
all copies of a (user, item) pair stay together, and the same split can be
written in SQL. ``random_split`` is Spark's sampler over an input written to the
shared folder first, so that recomputation cannot move rows between sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.functions.exprs import MIX_PRIME, TEST_FRACTION, mix, mix_sql
from dwellrec.session import materialize

SPLIT_SEED = 42


def _cut(test_fraction: float) -> int:
    if not 0.0 <= test_fraction <= 1.0:
        raise ValueError("test_fraction must be in [0, 1]")
    cut = round(test_fraction * MIX_PRIME)
    if test_fraction > 0 and not cut:
        raise ValueError(f"test_fraction {test_fraction} is below the split's resolution")
    return cut


def split_label(user: str = "user", item: str = "item",
                test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED):
    is_test = mix(F.col(user), F.col(item), seed) < F.lit(_cut(test_fraction))
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


def split_label_sql(user: str = "user", item: str = "item",
                    test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED) -> str:
    return (f"CASE WHEN {mix_sql(user, item, seed)} < {_cut(test_fraction)}"
            f" THEN 'test' ELSE 'train' END")


def hash_split(df: DataFrame, test_fraction: float = TEST_FRACTION,
               seed: int = SPLIT_SEED, user: str = "user", item: str = "item") -> DataFrame:
    """Add ``split`` ∈ {'train','test'} (narrow, no shuffle)."""
    return df.withColumn("split", split_label(user, item, test_fraction, seed))


def random_split(df: DataFrame, weights=(0.9, 0.1), seed: int = SPLIT_SEED):
    """Row-level random split (duplicates of a pair may straddle the sides)."""
    frozen = materialize(df, "random-split")
    return frozen.randomSplit(list(weights), seed)
