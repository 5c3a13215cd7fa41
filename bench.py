"""Benchmark the headline job steps; prints ONE JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_SHUFFLE_PARTITIONS (default 2 x cpus),
BENCH_REPEATS (default 3; the median per step is reported, after one warm-up
run on the smallest tables).

cuts, holdout split, ALS fit (rank 10, 10 iterations, lambda 1, alpha 1),
top-10 lines for all users, model save + reload, decision metrics, negative
sampling, mean AUC.
Each step is forced with a no-op sink or a small collect.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def run_once(spark, sf_dir):
    from pyspark.sql import functions as F

    from dwellrec.operators import model as als
    from dwellrec.operators.negatives import sample_negatives
    from dwellrec.operators.split import hash_split
    from dwellrec.plans import evaluate as E
    from dwellrec.plans import jobs as P
    from dwellrec.session import (
        drop_materialized,
        materialized_mark,
        scratch_path,
        track_materialized,
    )
    from dwellrec.sources.interactions import from_tables
    from dwellrec.sources.model_store import load_store, save_store

    t = {}
    mark = materialized_mark(spark)
    prep = P.prepare(from_tables(spark, sf_dir), timings=t)

    s = time.time()
    lab = hash_split(prep.scored)
    lab.groupBy("split").count().collect()
    t["holdout_split"] = time.time() - s

    s = time.time()
    params = als.AlsParams.for_evaluation(rank=10, max_iter=10, reg_param=1.0, alpha=1.0)
    model = als.fit(lab.where(F.col("split") == "train"), params)
    model.userFactors.count()
    t["als_fit"] = time.time() - s

    s = time.time()
    _noop(P.recommend(model, prep.user_index, 10))
    t["top10_all_users"] = time.time() - s

    s = time.time()
    store = scratch_path(spark, "bench-store")
    track_materialized(spark, store)
    save_store(store, model, prep.user_index, params.as_dict(), prep.cuts)
    reloaded, _, _ = load_store(spark, store)
    reloaded.userFactors.count()
    t["model_save_reload"] = time.time() - s
    model = reloaded          # like evaluate: later steps read the saved factors

    # from here on the functions that evaluate runs
    s = time.time()
    cat, n_items = prep.catalogue()
    negs = sample_negatives(lab.select("split", "user", "item"), cat, n_items, by=["split"])
    t["negative_sampling"] = time.time() - s

    s = time.time()
    scored = E.predicted_pairs(model, E.evaluation_pairs(lab, negs))
    E.decisions(scored).collect()
    t["decision_metrics"] = time.time() - s

    s = time.time()
    E.ranking(scored).collect()
    t["mean_auc"] = time.time() - s

    prep.release()
    drop_materialized(spark, since=mark)
    return t


def main():
    from dwellrec.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, 2 * cpus)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=partitions,
                          conf={"spark.driver.memory": "12g"})
    # warm-up on the smallest tables (JIT, class loading)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        run_once(spark, warm)
    runs = [run_once(spark, sf_dir) for _ in range(repeats)]
    steps = {k: round(statistics.median(r[k] for r in runs), 3) for k in runs[0]}
    total = round(sum(steps.values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "als_job_total", "value": total, "unit": "sec",
                      "queries": steps, "sf": sf, "cpus": cpus, "repeats": repeats,
                      "spark": spark.version, "shuffle_partitions": partitions,
                      "driver_memory": spark.conf.get("spark.driver.memory", None)}))
    spark.stop()


if __name__ == "__main__":
    main()
