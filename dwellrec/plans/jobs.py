"""End-to-end jobs (evaluation and sweeps are in ``evaluate.py``).

* ``prepare``          interactions → visitor index → ratings → quintile scores
* ``prepare_ratings``  the same for inputs with integer ids (legacy files)
* ``train``            prepare, fit on everything, save model + index + params
* ``recommend``        top-N lines for every visitor (``recommendation_lists``
                       for the structured form, ``recommend_from_store`` from
                       a saved store)

Materialisation points: the sorted visitor keys (with their positions) and
the id-attached ratings are written as Parquet tables in the shared
checkpoint folder, and a saved model is reloaded before use (lineage cut; an
executor loss re-reads files). The driver receives only counts per
partition/bucket, the cut values, the catalogue size and the final rows.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.functions.exprs import SCORE_BINS, TOP_N
from dwellrec.operators import model as als
from dwellrec.operators.export import lines_from_lists
from dwellrec.operators.index import attach_user_ids, build_user_index, item_catalogue
from dwellrec.operators.score import apply_scores, cut_values, quintile_cuts
from dwellrec.session import materialize
from dwellrec.sources.interactions import clean, input_fingerprint, shift_ratings
from dwellrec.sources.model_store import load_store, save_store


@dataclass
class Prepared:
    user_index: DataFrame   # visitor_trace, user, n_rows
    ratings: DataFrame      # user, item, rating (raw strength)
    scored: DataFrame       # user, item, score
    cuts: list[float]
    n: int
    _catalogue: tuple | None = None

    def catalogue(self) -> tuple[DataFrame, int]:
        """(item catalogue, number of items), built once per preparation."""
        if self._catalogue is None:
            cat = item_catalogue(self.scored)
            self._catalogue = (cat, cat.count())
        return self._catalogue

    def release(self) -> None:
        """Drop cached copies (files stay until ``drop_materialized``)."""
        self.ratings.unpersist()


def prepare(interactions: DataFrame, bins: int = SCORE_BINS,
            timings: dict | None = None, cache_input: bool = False) -> Prepared:
    """The cleaned interactions are read twice (index, id join). By default
    the source is simply evaluated twice: the index pass needs only the
    visitor column, so column pruning makes it the narrower read, and nothing
    as wide as whole interaction rows is cached (measured faster than caching
    on the test tables). ``cache_input`` persists them instead, for sources
    that are costly to recompute. The id-attached ratings are written once as
    a Parquet table in the shared checkpoint folder: later stages (three
    selection passes, ALS, metrics) scan those files instead of the source,
    and their plans stay shallow."""
    t0 = time.time()
    inter = clean(interactions)
    if cache_input:
        inter = inter.persist(StorageLevel.MEMORY_AND_DISK)
    index = build_user_index(inter)
    ratings = materialize(attach_user_ids(inter, index), "ratings")
    if cache_input:
        inter.unpersist()
    t1 = time.time()
    cuts_df, n = quintile_cuts(ratings, "rating", bins)
    cuts = cut_values(cuts_df)
    scored = apply_scores(ratings, cuts)
    if timings is not None:
        timings["user_index_and_ratings"] = t1 - t0
        timings["quintile_cuts"] = time.time() - t1
    return Prepared(index, ratings, scored, cuts, n)


def prepare_ratings(ratings: DataFrame, bins: int | None = SCORE_BINS,
                    offset: float | None = None) -> Prepared:
    """For inputs that already carry integer ids (user INT, item INT, rating
    DOUBLE), e.g. the tab-separated legacy files: optional shift of the
    strength by ``offset``, then quintile scores (``bins=None`` keeps the
    strength itself as the score). The index maps each id to its own text."""
    clean_rows = ratings.where(F.col("user").isNotNull() & F.col("item").isNotNull()
                               & F.col("rating").isNotNull() & ~F.isnan("rating"))
    if offset is not None:
        clean_rows = shift_ratings(clean_rows, offset)
    rated = materialize(clean_rows.select("user", "item", "rating"), "ratings")
    index = (rated.select("user").distinct()
             .select(F.col("user").cast("string").alias("visitor_trace"), "user"))
    if bins is None:
        n = rated.count()
        return Prepared(index, rated, rated.withColumnRenamed("rating", "score"), [], n)
    cuts_df, n = quintile_cuts(rated, "rating", bins)
    cuts = cut_values(cuts_df)
    return Prepared(index, rated, apply_scores(rated, cuts), cuts, n)


def train(interactions: DataFrame, model_dir: str | None = None,
          params: als.AlsParams = als.AlsParams(), bins: int = SCORE_BINS,
          mode: str = "errorifexists", record_input: bool = False):
    """Fit on all scored ratings; save to ``model_dir`` when given, with the
    input's fingerprint if ``record_input`` (one more pass over the input;
    ``same_input`` checks it later). Returns (model, Prepared)."""
    prep = prepare(interactions, bins)
    seen = input_fingerprint(interactions).first().asDict() if record_input else None
    return fit_prepared(prep, model_dir, params, mode, seen), prep


def same_input(meta: dict, interactions: DataFrame) -> bool:
    """Whether ``interactions`` are the rows that a store's model was trained on
    (``meta`` from ``load_store``)."""
    if not meta.get("input"):
        raise ValueError("the store records no input fingerprint")
    return meta["input"] == input_fingerprint(interactions).first().asDict()


def fit_prepared(prep: Prepared, model_dir: str | None = None,
                 params: als.AlsParams = als.AlsParams(), mode: str = "errorifexists",
                 seen: dict | None = None):
    """Fit on all scored ratings of ``prep``; when ``model_dir`` is given,
    save the store there and return the reloaded model (its factors are then
    files, not ALS lineage)."""
    model = als.fit(prep.scored, params)
    if model_dir:
        meta = params.as_dict() | ({"input": seen} if seen else {})
        save_store(model_dir, model, prep.user_index, meta, prep.cuts, mode)
        model = load_store(prep.scored.sparkSession, model_dir)[0]
    return model


def recommend(model, user_index: DataFrame, n: int = TOP_N) -> DataFrame:
    """(user, visitor_trace, value) text lines for every user of the model."""
    return lines_from_lists(als.recommend_all(model, n), user_index)


def recommendation_lists(model, user_index: DataFrame, n: int = TOP_N,
                         visitors: DataFrame | None = None) -> DataFrame:
    """Structured form: (user, visitor_trace, recommendations
    ARRAY<STRUCT<item INT, rating FLOAT>>), lists in descending order, for all
    visitors or for ``visitors`` (visitor_trace) only, which bounds the
    users x items product."""
    index = user_index.select("user", "visitor_trace")
    if visitors is None:
        return als.recommend_all(model, n).join(index, "user")
    some = materialize(index.join(visitors.select("visitor_trace").distinct(), "visitor_trace"),
                       "served-visitors")
    return als.recommend_subset(model, als.near_ids(some), n).join(some, "user")


def recommend_from_store(spark, model_dir: str, n: int = TOP_N,
                         visitors: DataFrame | None = None) -> DataFrame:
    """Top-N lines from a saved store, for all visitors or some."""
    model, index, _ = load_store(spark, model_dir)
    lists = recommendation_lists(model, index, n, visitors)
    return lines_from_lists(lists.select("user", "recommendations"), index)


def peek(df: DataFrame, n: int = 3) -> DataFrame:
    """A few rows for a look (the studied job printed take(3) samples)."""
    return df.limit(n)
