"""Quintile scoring of raw strengths and dataset statistics.

The cut points are the values at 1-based ranks k·⌊n/bins⌋ (k = 1..bins-1) of
the ascending ratings; a rating ≤ cut k gets score k-1 (ties fall in the lower
bin, bins may be uneven). This is exact rank selection, not ``ntile`` and not
``percentile_disc``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.functions.exprs import SCORE_BINS, score_cascade
from dwellrec.operators.ranking import rank_values


def cut_ranks(n: int, bins: int = SCORE_BINS) -> list[int]:
    if n < bins:
        raise ValueError(f"quintile scoring needs at least {bins} ratings, got {n}")
    size = n // bins
    return [k * size for k in range(1, bins)]


def quintile_cuts(ratings: DataFrame, col: str = "rating",
                  bins: int = SCORE_BINS) -> tuple[DataFrame, int]:
    """(DataFrame[k INT, rank BIGINT, cut DOUBLE], n)."""
    out, n = rank_values(ratings, col, rank_fn=lambda n: cut_ranks(n, bins))
    return out.select("k", "rank", F.col("value").alias("cut")), n


def cut_values(cuts: DataFrame) -> list[float]:
    """The bins-1 cut values, in k order (bounded: bins-1 rows)."""
    return [float(r["cut"]) for r in cuts.orderBy("k").collect()]


def apply_scores(ratings: DataFrame, cuts: list[float], col: str = "rating",
                 out: str = "score") -> DataFrame:
    """Replace the raw strength with its bin index (narrow; cuts are literals)."""
    keep = [c for c in ratings.columns if c != col]
    return ratings.select(*keep, score_cascade(F.col(col), cuts).alias(out))


def quintile_scores(ratings: DataFrame, col: str = "rating", bins: int = SCORE_BINS,
                    out: str = "score") -> tuple[DataFrame, list[float]]:
    cuts_df, _ = quintile_cuts(ratings, col, bins)
    cuts = cut_values(cuts_df)
    return apply_scores(ratings, cuts, col, out), cuts


def dataset_stats(scored: DataFrame, user: str = "user", item: str = "item",
                  approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """One row: ratings, distinct users, distinct items (HyperLogLog++
    estimates with ``approx`` and relative error ``rsd``, one pass without a
    distinct shuffle)."""
    def distinct(c):
        return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)

    return scored.agg(F.count(F.lit(1)).alias("ratings"),
                      distinct(user).alias("users"),
                      distinct(item).alias("items"))


def dataset_stats_by(scored: DataFrame, by: list[str], user: str = "user", item: str = "item") -> DataFrame:
    """Exact distinct users and items per group of ``by``."""
    return scored.groupBy(*by).agg(F.count_distinct(user).alias("users"), F.count_distinct(item).alias("items"))


SKETCH_LG = 14          # 2^14 hashes a sketch: a relative error of 0.8 %


def stats_sketches(scored: DataFrame, keys: list[str], user: str = "user", item: str = "item",
                   lg: int = SKETCH_LG) -> DataFrame:
    """One row per group of ``keys`` (a day, a file, a side, ...): rows and the
    theta sketches of its users and items, at most 8·2^lg bytes each."""
    return scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("ratings"), F.theta_sketch_agg(user, F.lit(lg)).alias("users"),
        F.theta_sketch_agg(item, F.lit(lg)).alias("items"))


def add_sketches(kept: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """``kept`` with the groups of ``fresh`` added; a group held already is
    replaced, so that a batch read twice counts once."""
    return kept.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def stats_from_sketches(kept: DataFrame, by: list[str] | None = None, lg: int = SKETCH_LG) -> DataFrame:
    """``dataset_stats`` of all groups together (or per ``by``): exact row counts,
    estimated distinct users and items. Reads the sketches, never the ratings."""
    return kept.groupBy(*(by or [])).agg(
        F.sum("ratings").alias("ratings"),
        *[F.theta_sketch_estimate(F.theta_union_agg(c, F.lit(lg))).alias(c) for c in ("users", "items")])


def overlap_from_sketches(kept: DataFrame, side: str, a, b, lg: int = SKETCH_LG) -> DataFrame:
    """One row: estimated users and items common to the groups with ``side`` = a
    and those with ``side`` = b."""
    def merged(value, c):
        return F.theta_union_agg(F.when(F.col(side) == F.lit(value), F.col(c)), F.lit(lg))

    return kept.agg(*[F.theta_sketch_estimate(F.theta_intersection(merged(a, c), merged(b, c))).alias(c)
                      for c in ("users", "items")])
