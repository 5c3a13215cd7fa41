"""The public surface under one roof.

| Job / function                 | Here                                   |
| ------------------------------ | -------------------------------------- |
| evaluate one parameter set     | ``evaluate(interactions, params)``     |
| parameter sweep                | ``sweep(interactions, grid)``          |
| confusion counts               | ``confusion(pairs, threshold)``        |
| decision metrics               | ``decision_metrics(pairs, threshold)`` |
| metric report text             | ``format_metrics(metrics, delimiter)`` |
| mean AUC per side              | ``ranking_metrics(lab, negs, model)``  |
| per-user AUC / its mean        | ``user_auc``, ``mean_auc``             |
| RMSE                           | ``rmse(pairs, mapping)``               |
| train and save                 | ``train(interactions, model_dir)``     |
| top-N lines from a saved model | ``recommend_all(spark, model_dir, n)`` |
| exact dense ids / rank values  | ``global_rank``, ``select_ranks``      |
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dwellrec.functions.exprs import DECISION_THRESHOLD
from dwellrec.operators import metrics as _m
from dwellrec.operators.index import attach_user_ids, build_user_index, item_catalogue  # noqa: F401
from dwellrec.operators.metrics import (  # noqa: F401
    mean_auc,
    rmse,
    user_auc,
    weighted_facts,
    weighted_pairs,
)
from dwellrec.operators.model import AlsParams, fit, predict_pairs  # noqa: F401
from dwellrec.operators.negatives import sample_negatives  # noqa: F401
from dwellrec.operators.ranking import dense_ids as global_rank  # noqa: F401
from dwellrec.operators.ranking import rank_values as select_ranks  # noqa: F401
from dwellrec.operators.score import dataset_stats, quintile_cuts, quintile_scores  # noqa: F401
from dwellrec.operators.split import hash_split, random_split  # noqa: F401
from dwellrec.plans.evaluate import evaluate, scored_negatives, scored_positives, sweep  # noqa: F401
from dwellrec.plans.jobs import prepare, prepare_ratings, recommend, train  # noqa: F401
from dwellrec.plans.jobs import recommend_from_store as recommend_all  # noqa: F401
from dwellrec.sources.interactions import from_tables, read_table, read_tsv  # noqa: F401
from dwellrec.sources.model_store import load_store, save_store  # noqa: F401
from dwellrec.sources.sinks import write_parquet, write_text  # noqa: F401


def confusion(pairs: DataFrame, threshold: float = DECISION_THRESHOLD,
              by: Sequence[str] = ()) -> DataFrame:
    return _m.confusion_counts(pairs, threshold, by)


def decision_metrics(pairs: DataFrame, threshold: float = DECISION_THRESHOLD,
                     by: Sequence[str] = ()) -> DataFrame:
    return _m.decision_metrics(_m.confusion_counts(pairs, threshold, by))


def format_metrics(metrics: DataFrame, delimiter: str = ",") -> DataFrame:
    return _m.metrics_report(metrics, delimiter)


def ranking_metrics(lab: DataFrame, negs: DataFrame, model) -> DataFrame:
    """Mean per-user AUC per side: ``lab`` (split, user, item, ...) rows are
    the positives, ``negs`` the sampled negatives (see ``sample_negatives``)."""
    per_user = user_auc(scored_positives(model, lab), scored_negatives(model, negs),
                        by=["split"])
    return mean_auc(per_user, by=["split"])
