"""Registered queries (their DuckDB oracle SQL is in ``oracle.py``).

Each query is ``(spark, sf_dir) -> DataFrame`` over the whole test tables.
The fixture is the interaction table built from customer ⋈ orders ⋈
lineitem (visitor = customer name, item = part key, strength = extended
price, or quantity for the heavy-ties variant). Model outputs are replaced,
where an oracle must reproduce them, by integer-exact stand-ins: a hash
prediction for the evaluation operators and quantised ``embeddings`` factors
for pair scoring and top-N (an id uses the vector numbered by its remainder).
The ``als_*`` queries run the real Spark ML model and return what does not
depend on its floats. The ``skewed_*`` queries run on the same interactions
with every third customer relabelled to one visitor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dwellrec.functions.exprs import (
    DECISION_THRESHOLD,
    SCORE_BINS,
    TEST_FRACTION,
    TOP_N,
    binarise,
    surrogate_pred,
)
from dwellrec.operators import metrics as M
from dwellrec.operators import model as als
from dwellrec.operators.allpairs import top_n_all
from dwellrec.operators.export import format_line, lines_from_ranked, sort_lists_ascending
from dwellrec.operators.index import build_user_index, extend_user_index
from dwellrec.operators.model import AlsParams
from dwellrec.operators.negatives import NEG_SEED, sample_negatives
from dwellrec.operators.score import (
    add_sketches,
    dataset_stats,
    dataset_stats_by,
    overlap_from_sketches,
    quintile_cuts,
    stats_from_sketches,
    stats_sketches,
)
from dwellrec.operators.split import SPLIT_SEED, hash_split, random_split
from dwellrec.operators.topn import pair_scores, quantised_factors, top_n
from dwellrec.plans import jobs as P
from dwellrec.plans.crossval import FOLDS, cross_validate, fold_labels
from dwellrec.plans.evaluate import evaluate_prepared, sweep_prepared
from dwellrec.session import materialize, on_drop, scratch_path, track_materialized
from dwellrec.sources.interactions import (
    clean,
    dropped_counts,
    from_tables,
    input_fingerprint,
    read_table,
    read_tsv,
    shift_ratings,
    table,
)
from dwellrec.sources.model_store import load_store, save_store
from dwellrec.sources.sinks import write_text

PRICE = "l_extendedprice"
QUANTITY = "l_quantity"
SHIFT = 5.0

# ---------------------------------------------------------------------------
# Shared fixture (memoised per application, table folder and strength column)
# ---------------------------------------------------------------------------
_PREPARED: dict = {}
on_drop(_PREPARED.clear)
HOT_VISITOR = "HOT"


def interactions(spark: SparkSession, sf_dir: str, rating_col: str = PRICE,
                 skewed: bool = False) -> DataFrame:
    """The interaction table; ``skewed`` relabels every third customer to one
    visitor, which then holds about a third of all rows."""
    rows = from_tables(spark, sf_dir, rating_col)
    if skewed:
        number = F.regexp_extract("visitor_trace", "([0-9]+)$", 1).cast("bigint")
        rows = rows.withColumn("visitor_trace", F.when(number % 3 == 0, F.lit(HOT_VISITOR))
                               .otherwise(F.col("visitor_trace")))
    return rows


def prepared(spark: SparkSession, sf_dir: str, rating_col: str = PRICE,
             skewed: bool = False) -> P.Prepared:
    key = (spark.sparkContext.applicationId, sf_dir, rating_col, skewed)
    if key not in _PREPARED:
        _PREPARED[key] = P.prepare(interactions(spark, sf_dir, rating_col, skewed))
    return _PREPARED[key]


def labelled(spark, sf_dir, test_fraction=TEST_FRACTION, skewed=False) -> DataFrame:
    return hash_split(prepared(spark, sf_dir, skewed=skewed).scored, test_fraction, SPLIT_SEED)


def _surrogate_preds(df: DataFrame) -> DataFrame:
    return (df.select("user", "item").distinct()
            .withColumn("pred", surrogate_pred(F.col("user"), F.col("item"))))


def _pairs(spark, sf_dir, mode="bag") -> DataFrame:
    lab = labelled(spark, sf_dir)
    return M.weighted_pairs(lab.select("split", "user", "item", "score"),
                            _surrogate_preds(lab), mode=mode, by=["split"])


def _negatives(spark, sf_dir, skewed=False) -> DataFrame:
    cat, n_items = prepared(spark, sf_dir, skewed=skewed).catalogue()
    lab = labelled(spark, sf_dir, skewed=skewed)
    return sample_negatives(lab.select("split", "user", "item"), cat, n_items,
                            NEG_SEED, by=["split"])


def _user_auc(spark, sf_dir, skewed=False) -> DataFrame:
    lab = labelled(spark, sf_dir, skewed=skewed)
    pos = lab.select("split", "user", surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
    negs = _negatives(spark, sf_dir, skewed)
    neg = negs.select("split", "user", surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
    return M.user_auc(pos, neg, by=["split"])


def _factor_scores(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    fac = quantised_factors(vectors)
    return pair_scores(prepared(spark, sf_dir).scored, fac, fac, vectors.count())


def _topn(spark, sf_dir) -> DataFrame:
    return top_n(_factor_scores(spark, sf_dir), TOP_N)


# ---------------------------------------------------------------------------
# Table-valued queries with an oracle
# ---------------------------------------------------------------------------

def _bigint(df: DataFrame, *names: str) -> DataFrame:
    """Wide counts as BIGINT (the test tables' counts fit; ANSI casts raise)."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in names})


def q_scan_interactions(spark, sf_dir):
    return clean(from_tables(spark, sf_dir, PRICE))


def q_ingest_counts(spark, sf_dir):
    return dropped_counts(from_tables(spark, sf_dir, PRICE))


def q_user_index(spark, sf_dir):
    return prepared(spark, sf_dir).user_index.select("visitor_trace", "user", "n_rows")


def q_item_catalogue(spark, sf_dir):
    return prepared(spark, sf_dir).catalogue()[0]


def q_indexed_ratings(spark, sf_dir):
    return prepared(spark, sf_dir).ratings


def q_quintile_cuts(spark, sf_dir):
    return quintile_cuts(prepared(spark, sf_dir).ratings, "rating", SCORE_BINS)[0]


def q_quintile_scores(spark, sf_dir):
    return prepared(spark, sf_dir).scored


def q_quintile_scores_ties(spark, sf_dir):
    return prepared(spark, sf_dir, QUANTITY).scored


def q_dataset_stats(spark, sf_dir):
    return dataset_stats(prepared(spark, sf_dir).scored)


def q_holdout_split(spark, sf_dir):
    return labelled(spark, sf_dir)


def q_holdout_split_80_20(spark, sf_dir):
    return labelled(spark, sf_dir, 0.2)


def q_shifted_ratings(spark, sf_dir):
    return shift_ratings(prepared(spark, sf_dir).ratings, SHIFT)


def q_binarised_test_labels(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    return (lab.where(F.col("split") == "test")
            .select("user", "item", binarise(F.col("score")).alias("label")))


def q_pair_predictions(spark, sf_dir):
    return _factor_scores(spark, sf_dir)


def q_fact_pred_join(spark, sf_dir):
    return _bigint(_pairs(spark, sf_dir, "bag"), "weight")


def q_fact_pred_join_rowmode(spark, sf_dir):
    return _bigint(_pairs(spark, sf_dir, "row"), "weight")


def q_confusion_counts(spark, sf_dir):
    counts = M.confusion_counts(_pairs(spark, sf_dir), DECISION_THRESHOLD, by=["split"])
    return _bigint(counts, "tp", "fp", "fn", "tn")


def q_confusion_metrics(spark, sf_dir):
    return M.decision_metrics(q_confusion_counts(spark, sf_dir))


def q_metrics_text(spark, sf_dir):
    rep = M.metrics_report(q_confusion_metrics(spark, sf_dir), ",")
    return rep.select("split", "report", "list_line")


def q_rmse_binarised(spark, sf_dir):
    return _bigint(M.rmse(_pairs(spark, sf_dir), "binary", by=["split"]), "n")


def q_rmse_clamped(spark, sf_dir):
    return _bigint(M.rmse(_pairs(spark, sf_dir), "clamp", by=["split"]), "n")


def q_rmse_raw(spark, sf_dir):
    return _bigint(M.rmse(_pairs(spark, sf_dir), "raw", by=["split"]), "n")


def q_negative_samples(spark, sf_dir):
    return _negatives(spark, sf_dir)


def q_user_auc(spark, sf_dir):
    return _user_auc(spark, sf_dir)


def q_mean_auc(spark, sf_dir):
    return M.mean_auc(_user_auc(spark, sf_dir), by=["split"])


def q_skewed_user_index(spark, sf_dir):
    return prepared(spark, sf_dir, skewed=True).user_index.select("visitor_trace", "user", "n_rows")


def q_skewed_indexed_ratings(spark, sf_dir):
    return prepared(spark, sf_dir, skewed=True).ratings


def q_skewed_negative_samples(spark, sf_dir):
    return _negatives(spark, sf_dir, skewed=True)


def q_skewed_user_auc(spark, sf_dir):
    return _user_auc(spark, sf_dir, skewed=True)


def q_table_scan(spark, sf_dir):
    """A catalog table read by name, columns picked by name."""
    src = from_tables(spark, sf_dir, PRICE).toDF("who", "what", "secs")
    src.select("secs", "who", "what").createOrReplaceTempView("dwellrec_visits")
    return read_table(spark, "dwellrec_visits", visitor="who", item="what", rating="secs")


def q_tsv_ratings(spark, sf_dir):
    """The ratings written as tab-separated text and read back."""
    path = scratch_path(spark, "tsv")
    track_materialized(spark, path)
    prepared(spark, sf_dir).ratings.select("user", "item", "rating").write.csv(path, sep="\t")
    return read_tsv(spark, path)


def q_text_sink_lines(spark, sf_dir):
    """Recommendation lines through the text sink and back."""
    path = scratch_path(spark, "lines")
    track_materialized(spark, path)
    write_text(q_recommendation_lines(spark, sf_dir), path)
    return spark.read.text(path)


def q_peek(spark, sf_dir):
    """The first visitors of the index."""
    return P.peek(prepared(spark, sf_dir).user_index.select("visitor_trace", "user").orderBy("user"))


def q_topn_rated_items(spark, sf_dir):
    """The best of each visitor's rated items, every visitor."""
    return _topn(spark, sf_dir)


NORM_STEPS = 5     # item norms of the stand-in factors vary, as popularity makes them


CV_FOLDS = 3


def q_cv_folds(spark, sf_dir):
    return fold_labels(prepared(spark, sf_dir).scored, FOLDS)


def q_als_cross_validated(spark, sf_dir):
    """Two grid points over three folds: what does not depend on the model's floats."""
    grid = [_eval_params(rank=5, max_iter=5), _eval_params(rank=8, max_iter=5)]
    rows = cross_validate(prepared(spark, sf_dir), grid, CV_FOLDS)
    chosen = rows.agg(F.count_if("chosen").alias("n")).select((F.col("n") == 1).alias("one_chosen"))
    valid = F.col("auc_mean").between(0, 1) & (F.col("auc_se") >= 0) & F.col("f").between(0, 1)
    return rows.select("rank", "max_iter", "folds", "rows", "negatives", valid.alias("valid"),
                       F.lit(chosen.first()[0]).alias("one_chosen"))


def q_user_index_extended(spark, sf_dir):
    """The index of the even items' interactions by two thirds of the visitors,
    grown by all others."""
    rows = clean(from_tables(spark, sf_dir, PRICE))
    number = F.regexp_extract("visitor_trace", "([0-9]+)$", 1).cast("bigint")
    early = (number % 3 != 0) & (F.col("poi") % 2 == 0)
    return extend_user_index(build_user_index(rows.where(early)), rows.where(~early))


def q_input_fingerprint(spark, sf_dir):
    return input_fingerprint(from_tables(spark, sf_dir, PRICE))


def q_topn_all_users(spark, sf_dir):
    """The best of all catalogue items for every visitor, stand-in factors."""
    vectors = table(spark, sf_dir, "embeddings")
    n = vectors.count()
    fac = quantised_factors(vectors)
    prep = prepared(spark, sf_dir)
    users = prep.user_index.select(F.col("user").alias("to"), F.pmod("user", F.lit(n)).alias("id"))
    items = prep.catalogue()[0].select(F.col("item").alias("to"), F.pmod("item", F.lit(n)).alias("id"))
    weight = (F.lit(1) + F.pmod("to", F.lit(NORM_STEPS))).cast("bigint")
    users = users.join(fac, "id").select(F.col("to").alias("id"), F.col("q").alias("v"))
    items = items.join(fac, "id").select(F.col("to").alias("id"),
                                         F.transform("q", lambda x: x * weight).alias("v"))
    return top_n_all(users, items, TOP_N)


def q_recommendation_lines(spark, sf_dir):
    return lines_from_ranked(_topn(spark, sf_dir), prepared(spark, sf_dir).user_index)


def q_topn_lists_ascending(spark, sf_dir):
    top = _topn(spark, sf_dir)
    lists = top.groupBy("user").agg(F.array_sort(F.collect_list(
        F.struct("rank", "item", F.col("score").alias("rating")))).alias("recommendations"))
    lists = lists.withColumn("recommendations", F.transform(
        "recommendations", lambda r: F.struct(r["item"].alias("item"), r["rating"].alias("rating"))))
    asc = sort_lists_ascending(lists)
    idx = prepared(spark, sf_dir).user_index.select("user", "visitor_trace")
    return (asc.join(idx, "user")
            .select("user", "visitor_trace",
                    format_line(F.col("visitor_trace"), F.col("recommendations"), "item", "rating")
                    .alias("value")))


# ---------------------------------------------------------------------------
# Model queries (Spark ML ALS): the part that does not depend on its floats
# ---------------------------------------------------------------------------

def _als_params(**kw) -> AlsParams:
    """Rank 10, lambda 1, alpha 1 as in the studied jobs; 10 iterations."""
    return AlsParams(**{**dict(rank=10, max_iter=10, reg_param=1.0, alpha=1.0), **kw})


def _eval_params(**kw) -> AlsParams:
    return AlsParams.for_evaluation(**{**dict(rank=10, max_iter=10), **kw})


FLOAT_ERROR = 1e-4     # of a single-precision product, relative


def _close(a, b):
    return F.abs(a - b) <= F.lit(FLOAT_ERROR) * F.greatest(F.lit(1.0), F.abs(b))


def _product(rows: DataFrame, model) -> DataFrame:
    """rows (user, item, …) with ``exact``, the product of the fitted factors."""
    uf, itf = (x.select(F.col("id").alias(to), F.col("features").cast("array<double>").alias(c))
               for x, to, c in ((model.userFactors, "user", "_uf"), (model.itemFactors, "item", "_if")))
    dot = F.aggregate(F.zip_with("_uf", "_if", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return rows.join(uf, "user").join(itf, "item").withColumn("exact", dot).drop("_uf", "_if")


def _ranked_grid(recommendations: DataFrame, model) -> DataFrame:
    """(user, rank, in_order, agrees): whether the score is at most the one before,
    and whether it is both the listed item's product of factors and the
    rank-th best product over all items (so no unlisted item is better)."""
    flat = als.flatten_recommendations(recommendations)
    before = F.lag("rating").over(Window.partitionBy("user").orderBy("rank"))   # a list's rows
    flat = flat.withColumn("in_order", F.coalesce(before, F.col("rating")) >= F.col("rating"))
    best = als.recommend_exact(model, TOP_N, recommendations.select("user")).select(
        "user", "rank", F.col("rating").alias("best"))
    both = _product(flat, model).join(best, ["user", "rank"])
    return both.select("user", "rank", "in_order",
                       (_close(F.col("rating"), F.col("exact")) & _close(F.col("rating"), F.col("best")))
                       .alias("agrees"))


def q_holdout_random_split(spark, sf_dir):
    """Row-level seeded split over a checkpointed input: per distinct row the copies
    on both sides together, and whether the test side's size is within five
    standard deviations of its share, and sizes repeat when run again and add up."""
    scored = prepared(spark, sf_dir).scored
    train, test = random_split(scored, (0.9, 0.1), SPLIT_SEED)
    n, held = scored.count(), test.count()
    binomial = abs(held - 0.1 * n) <= 5 * (0.09 * n) ** 0.5
    same = test.count() == held and train.count() + held == n
    sides = train.withColumn("t", F.lit(0)).unionByName(test.withColumn("t", F.lit(1)))
    return sides.groupBy("user", "item", "score").agg(F.count("*").alias("copies")).select(
        "*", F.lit(binomial).alias("sizes_fit"), F.lit(same).alias("same_sides"))


def q_dataset_stats_approx(spark, sf_dir):
    """Distinct counts by HyperLogLog++ within 5 % of the exact ones."""
    scored = prepared(spark, sf_dir).scored
    exact = dataset_stats(scored)
    approx = dataset_stats(scored, approx=True).toDF("r", "u", "i")
    both = exact.join(approx, F.col("ratings") == F.col("r"))
    return both.select("ratings", "users", "items", *[
        (F.abs(F.col(a) - F.col(e)) <= F.col(e) * 0.05).alias(f"{e}_close")
        for a, e in (("u", "users"), ("i", "items"))])


def q_dataset_stats_incremental(spark, sf_dir):
    """Statistics per side from sketches of four item batches, the last added later
    and one read twice, and the users common to both sides; each within its bound
    of the exact count (the bound of a common count follows the union)."""
    lab = labelled(spark, sf_dir).withColumn("batch", F.col("item") % 4)
    keys = ["split", "batch"]
    kept = materialize(stats_sketches(lab.where("batch < 3"), keys), "stats-sketches")
    kept = materialize(add_sketches(kept, stats_sketches(lab.where("batch >= 2"), keys), keys),
                       "stats-sketches")
    found = stats_from_sketches(kept, ["split"]).toDF("split", "ratings", "u", "i")
    common = overlap_from_sketches(kept, "split", "train", "test").first()["users"]
    sides = lab.groupBy("user").agg(F.count_distinct("split").alias("s")).agg(
        F.count_if(F.col("s") == 2).alias("common"), F.count("*").alias("all")).first()
    exact = dataset_stats_by(lab, ["split"])
    return found.join(exact, "split").select(
        "split", "ratings", "users", "items",
        *[(F.abs(F.col(a) - F.col(e)) <= F.col(e) * 0.04).alias(f"{e}_close") for a, e in (("u", "users"), ("i", "items"))],
        F.lit(sides["common"]).cast("bigint").alias("common_users"),
        F.lit(abs(common - sides["common"]) <= 0.04 * sides["all"]).alias("common_close"))


def als_lines(spark, sf_dir) -> DataFrame:
    """The flagship job's result: top-10 lines of every visitor."""
    prep = prepared(spark, sf_dir)
    return P.recommend(als.fit(prep.scored, _als_params()), prep.user_index, TOP_N)


def q_als_recommendation_lines(spark, sf_dir):
    parts = F.split("value", "\u0001")
    return als_lines(spark, sf_dir).select(
        "user", "visitor_trace", F.get(parts, 0).alias("line_visitor"),
        F.size(F.split(F.get(parts, 1), ";")).alias("entries"))


def q_als_pair_predictions(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    m = als.freeze(als.fit(lab.where(F.col("split") == "train"), _eval_params()), spark)
    preds = als.predict_pairs(m, lab.where(F.col("split") == "test"))
    return _product(preds, m).select("user", "item", (~F.isnan("pred")).alias("finite"),
                                     _close(F.col("pred"), F.col("exact")).alias("agrees"))


def q_als_topn(spark, sf_dir):
    m = als.freeze(als.fit(prepared(spark, sf_dir).scored, _als_params()), spark)
    return _ranked_grid(als.recommend_all(m, TOP_N), m)


def q_als_topn_subset(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    m = als.freeze(als.fit(prepared(spark, sf_dir).scored, _als_params()), spark)
    return _ranked_grid(als.recommend_subset(m, lab.where(F.col("split") == "test"), TOP_N), m)


def q_als_explicit(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    test = lab.where(F.col("split") == "test")
    m = als.fit(lab.where(F.col("split") == "train"),
                _als_params(implicit_prefs=False, reg_param=0.1))
    pairs = M.weighted_pairs(test.select("split", "user", "item", "score"),
                             als.predict_pairs(m, test), "bag", by=["split"])
    err = _bigint(M.rmse(pairs, "raw", by=["split"]), "n")
    # scores lie in 0..4: a model that learned anything is nearer than 2 on average
    return err.select("split", "n", (F.col("rmse") < 2).alias("learned"))


def _evaluation_digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "rank", "alpha", "implicit_prefs", "seed", "split", "rows", "negatives",
        (F.col("tp") + F.col("fn")).cast("bigint").alias("positive"),
        (F.col("fp") + F.col("tn")).cast("bigint").alias("other"), "users",
        F.col("mean_auc").between(0, 1).alias("auc_valid"))


def q_als_evaluate(spark, sf_dir):
    return _evaluation_digest(evaluate_prepared(prepared(spark, sf_dir), _eval_params()))


def q_als_sweep(spark, sf_dir):
    grid = [_eval_params(rank=5), _eval_params(rank=10, alpha=2.0)]
    return _evaluation_digest(sweep_prepared(prepared(spark, sf_dir), grid))


def q_als_save_reload_topn(spark, sf_dir):
    """The reloaded index, with whether the reloaded user and item factors are
    the saved ones and the visitor gets a full list."""
    prep = prepared(spark, sf_dir)
    params = _als_params()
    m = als.freeze(als.fit(prep.scored, params), spark)
    path = scratch_path(spark, "model-store")
    track_materialized(spark, path)
    save_store(path, m, prep.user_index, params.as_dict(), prep.cuts)
    again, index, _ = load_store(spark, path)
    was, now = (x.userFactors.select(F.col("id").alias("user"), F.col("features").alias(c))
                for x, c in ((m, "was"), (again, "now")))
    items = m.itemFactors.exceptAll(again.itemFactors).unionByName(
        again.itemFactors.exceptAll(m.itemFactors))
    lists = als.recommend_all(again, TOP_N).select("user", F.size("recommendations").alias("entries"))
    return (index.join(was, "user").join(now, "user").join(lists, "user")
            .select("visitor_trace", "user", (F.col("was") == F.col("now")).alias("same_user"),
                    F.lit(items.isEmpty()).alias("same_items"), "entries"))


QUERIES = {
    "scan_interactions": q_scan_interactions,
    "ingest_counts": q_ingest_counts,
    "user_index": q_user_index,
    "item_catalogue": q_item_catalogue,
    "indexed_ratings": q_indexed_ratings,
    "quintile_cuts": q_quintile_cuts,
    "quintile_scores": q_quintile_scores,
    "quintile_scores_ties": q_quintile_scores_ties,
    "dataset_stats": q_dataset_stats,
    "holdout_split": q_holdout_split,
    "holdout_split_80_20": q_holdout_split_80_20,
    "shifted_ratings": q_shifted_ratings,
    "binarised_test_labels": q_binarised_test_labels,
    "pair_predictions": q_pair_predictions,
    "fact_pred_join": q_fact_pred_join,
    "fact_pred_join_rowmode": q_fact_pred_join_rowmode,
    "confusion_counts": q_confusion_counts,
    "confusion_metrics": q_confusion_metrics,
    "metrics_text": q_metrics_text,
    "rmse_binarised": q_rmse_binarised,
    "rmse_clamped": q_rmse_clamped,
    "rmse_raw": q_rmse_raw,
    "negative_samples": q_negative_samples,
    "user_auc": q_user_auc,
    "mean_auc": q_mean_auc,
    "skewed_user_index": q_skewed_user_index,
    "skewed_indexed_ratings": q_skewed_indexed_ratings,
    "skewed_negative_samples": q_skewed_negative_samples,
    "skewed_user_auc": q_skewed_user_auc,
    "table_scan": q_table_scan,
    "tsv_ratings": q_tsv_ratings,
    "text_sink_lines": q_text_sink_lines,
    "peek": q_peek,
    "topn_rated_items": q_topn_rated_items,
    "topn_all_users": q_topn_all_users,
    "cv_folds": q_cv_folds,
    "als_cross_validated": q_als_cross_validated,
    "user_index_extended": q_user_index_extended,
    "input_fingerprint": q_input_fingerprint,
    "recommendation_lines": q_recommendation_lines,
    "topn_lists_ascending": q_topn_lists_ascending,
    "holdout_random_split": q_holdout_random_split,
    "dataset_stats_approx": q_dataset_stats_approx,
    "dataset_stats_incremental": q_dataset_stats_incremental,
    "als_recommendation_lines": q_als_recommendation_lines,
    "als_pair_predictions": q_als_pair_predictions,
    "als_topn": q_als_topn,
    "als_topn_subset": q_als_topn_subset,
    "als_explicit": q_als_explicit,
    "als_evaluate": q_als_evaluate,
    "als_sweep": q_als_sweep,
    "als_save_reload_topn": q_als_save_reload_topn,
}


def oracle_sql() -> dict[str, str]:
    from dwellrec.plans.oracle import oracle_sql as _sql
    return _sql()
