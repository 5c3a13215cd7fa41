"""Runs that resume after their driver died.

A run's stages are tables under a shared folder, in a subfolder named by the
input's fingerprint and the run's parameters. A stage counts once its marker,
created after its files, is there; the next run with the same input and
parameters reads it, and overwrites what an unfinished stage left behind.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellrec.functions.exprs import DECISION_THRESHOLD, TEST_FRACTION
from dwellrec.operators import model as als
from dwellrec.operators.index import attach_user_ids, build_user_index
from dwellrec.operators.negatives import NEG_SEED
from dwellrec.operators.score import apply_scores, cut_values, quintile_cuts
from dwellrec.operators.split import SPLIT_SEED
from dwellrec.plans import evaluate as E
from dwellrec.plans.jobs import Prepared
from dwellrec.sources.interactions import clean, input_fingerprint
from dwellrec.sources.model_store import exists, mark


def digest(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()[:16]


def table_fingerprint(df: DataFrame) -> dict:
    """Row count and sums of two row hashes over all columns: equal for equal
    multisets of rows, whatever their order."""
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cols).cast("decimal(20,0)")).cast("string").alias(name)
            for seed, name in ((1, "sum1"), (2, "sum2"))]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums).first().asDict() | {"columns": df.columns}


class Stages:
    """The stage tables of one run: ``folder``/<digest of input and parameters>/<stage>."""

    def __init__(self, spark: SparkSession, folder: str, fingerprint: dict, params):
        self.spark, self.at = spark, f"{folder}/{digest([fingerprint, params])}"

    def done(self, name: str) -> bool:
        return exists(self.spark, f"{self.at}/{name}/_COMPLETE")

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stage's table; ``build`` runs only where no complete one is there."""
        path = f"{self.at}/{name}"
        if not self.done(name):
            build().write.mode("overwrite").parquet(path)
            mark(self.spark, f"{path}/_COMPLETE")
        return self.spark.read.parquet(path)


def prepare(stages: Stages, interactions: DataFrame) -> Prepared:
    """``jobs.prepare`` with its index, ratings and cuts as stages."""
    inter = clean(interactions)
    index = stages.table("user-index", lambda: build_user_index(inter))
    ratings = stages.table("ratings", lambda: attach_user_ids(inter, index))
    cuts = cut_values(stages.table("cuts", lambda: quintile_cuts(ratings, "rating")[0]))
    return Prepared(index, ratings, apply_scores(ratings, cuts), cuts, ratings.count())


def sweep(interactions: DataFrame, grid: Sequence[als.AlsParams], folder: str,
          test_fraction: float = TEST_FRACTION, seed: int = SPLIT_SEED,
          threshold: float = DECISION_THRESHOLD, mode: str = "bag",
          neg_seed: int = NEG_SEED) -> DataFrame:
    """``evaluate.sweep`` that resumes: the preparation, the shared pairs and every
    finished grid point are read back. Grid points are stages of their own, so
    a longer grid adds to the same run."""
    spark = interactions.sparkSession
    stages = Stages(spark, folder, input_fingerprint(interactions).first().asDict(),
                    [test_fraction, seed, threshold, mode, neg_seed])
    prep = prepare(stages, interactions)
    lab = E.hash_split(prep.scored, test_fraction, seed)
    pairs = stages.table("pairs", lambda: E.pairs_of(prep, lab, neg_seed, mode))
    sizes = stages.table("sizes", lambda: E.sizes_of(pairs))
    large = stages.table("large-users", lambda: E.large_users(pairs))
    out = None
    for p in grid:
        rows = stages.table("point-" + digest(p.as_dict()),
                            lambda p=p: E._evaluate_model((lab, pairs, sizes, large), p, threshold))
        out = rows if out is None else out.unionByName(rows)
    return out
