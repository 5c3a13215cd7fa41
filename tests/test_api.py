from pyspark.sql import functions as F

from conftest import SF_SMALL
from dwellrec import api


def test_api_surface_runs(spark):
    prep = api.prepare(api.from_tables(spark, SF_SMALL))
    lab = api.hash_split(prep.scored)
    model = api.fit(lab.where(F.col("split") == "train"), api.AlsParams(rank=3, max_iter=3))
    cat = api.item_catalogue(prep.scored)
    negs = api.sample_negatives(lab.select("split", "user", "item"), cat, by=["split"])
    auc = api.ranking_metrics(lab, negs, model).collect()
    assert sorted(r.split for r in auc) == ["test", "train"]
    pairs = api.weighted_pairs(lab.select("split", "user", "item", "score"),
                               api.predict_pairs(model, lab), by=["split"])
    rep = api.format_metrics(api.decision_metrics(pairs, by=["split"])).collect()
    assert all(r.report.startswith("\naccuracy    = ") for r in rep)
