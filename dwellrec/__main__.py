"""Command line: ``python -m dwellrec {evaluate,train,recommend} ...``
(or ``spark-submit`` of this module).

* ``evaluate``  holdout metrics for one parameter set, or a sweep when a
                parameter is given several values (``--rank 5 10 20``)
* ``train``     fit on all interactions, save model + index + parameters
* ``recommend`` top-N lines for every visitor from a saved model

Input is a catalog table (``--table``), a file path (``--path``, with
``--format``), the TPC-H-style test tables (``--sf-dir``), or tab-separated
integer-id files (``--tsv``, optionally ``--shift`` and ``--raw-scores``);
column names are given with ``--visitor-col/--item-col/--rating-col``.
"""

from __future__ import annotations

import argparse
import itertools
import sys

from dwellrec.functions.exprs import TOP_N


def _prepared(spark, a):
    """Prepared ratings: legacy integer-id files (``--tsv``) or interactions.
    The session's partitions are sized from the input first."""
    from dwellrec.plans.jobs import prepare, prepare_ratings
    from dwellrec.session import input_bytes, size_session
    from dwellrec.sources.interactions import read_tsv
    rows = read_tsv(spark, a.tsv) if a.tsv else _input(spark, a)
    if not a.keep_conf:
        size_session(spark, a.input_bytes or input_bytes(rows))
    if a.tsv:
        return prepare_ratings(rows, None if a.raw_scores else 5, a.shift)
    return prepare(rows)


def _input(spark, a):
    from dwellrec.sources.interactions import from_tables, read_table
    if a.sf_dir:
        return from_tables(spark, a.sf_dir, a.rating_col or "l_extendedprice")
    src = a.table or a.path
    if not src:
        raise SystemExit("give --table, --path or --sf-dir")
    return read_table(spark, src, None if a.table else a.format,
                      visitor=a.visitor_col or "visitor_trace", item=a.item_col or "poi",
                      rating=a.rating_col or "rating")


def _params(a):
    from dwellrec.operators.model import AlsParams
    grid = itertools.product(a.rank, a.max_iter, a.reg_param, a.alpha)
    return [AlsParams(rank=r, max_iter=i, reg_param=l, alpha=al,
                      implicit_prefs=not a.explicit,
                      num_user_blocks=a.user_blocks, num_item_blocks=a.item_blocks,
                      checkpoint_interval=a.checkpoint_interval, seed=a.seed)
            for r, i, l, al in grid]


def _add_input(p):
    p.add_argument("--table")
    p.add_argument("--path")
    p.add_argument("--format", default="parquet")
    p.add_argument("--sf-dir")
    p.add_argument("--visitor-col")
    p.add_argument("--item-col")
    p.add_argument("--rating-col")
    p.add_argument("--tsv", help="tab-separated user, item, rating files (integer ids)")
    p.add_argument("--shift", type=float, help="subtract this from --tsv ratings")
    p.add_argument("--input-bytes", type=int,
                   help="size of the input, if its statistics are unknown or wrong")
    p.add_argument("--keep-conf", action="store_true",
                   help="use the session's partition settings instead of sizing them")
    p.add_argument("--raw-scores", action="store_true",
                   help="with --tsv: use the (shifted) rating itself, no quintile scores")


def _add_params(p, many: bool):
    n = "+" if many else None
    p.add_argument("--rank", type=int, nargs=n, default=[10] if many else 10)
    p.add_argument("--max-iter", "--numIterations", dest="max_iter", type=int, nargs=n,
                   default=[20] if many else 20)
    p.add_argument("--reg-param", "--lambda", dest="reg_param", type=float, nargs=n,
                   default=[1.0] if many else 1.0)
    p.add_argument("--alpha", type=float, nargs=n, default=[1.0] if many else 1.0)
    p.add_argument("--user-blocks", "--numUserBlocks", dest="user_blocks", type=int,
                   default=-1, help="-1: sized from the session and the input")
    p.add_argument("--item-blocks", "--numProductBlocks", dest="item_blocks", type=int,
                   default=-1)
    p.add_argument("--checkpoint-interval", type=int, default=10)
    p.add_argument("--explicit", action="store_true", help="explicit-feedback ALS")
    p.add_argument("--seed", type=int, default=42)


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="dwellrec")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ev = sub.add_parser("evaluate", help="holdout metrics per split")
    _add_input(ev)
    _add_params(ev, many=True)
    ev.add_argument("--test-fraction", type=float, default=0.1)
    ev.add_argument("--mode", choices=("bag", "row"), default="bag")
    ev.add_argument("--output", help="write the metric rows as Parquet here")
    ev.add_argument("--report", action="store_true",
                    help="print the text report per parameter set and side")
    tr = sub.add_parser("train", help="fit on everything and save the model store")
    _add_input(tr)
    _add_params(tr, many=False)
    tr.add_argument("model_dir")
    tr.add_argument("--lines", help="also write top-N lines here")
    tr.add_argument("--n", type=int, default=TOP_N)
    rc = sub.add_parser("recommend", help="top-N lines from a saved model store")
    rc.add_argument("model_dir")
    rc.add_argument("output")
    rc.add_argument("--n", type=int, default=TOP_N)
    rc.add_argument("--visitors", help="Parquet files with a visitor_trace column: only these")
    rc.add_argument("--parquet", action="store_true",
                    help="write the structured lists as Parquet instead of text lines")
    return ap


def main(argv=None) -> int:
    a = parser().parse_args(argv)
    from dwellrec.session import build_session, drop_materialized, materialized_mark
    spark = build_session()
    mark = materialized_mark(spark)
    if a.cmd == "evaluate":
        from dwellrec.plans.evaluate import evaluate_prepared, sweep_prepared
        prep = _prepared(spark, a)
        grid = _params(a)
        rows = (evaluate_prepared(prep, grid[0], test_fraction=a.test_fraction, mode=a.mode)
                if len(grid) == 1 else
                sweep_prepared(prep, grid, test_fraction=a.test_fraction, mode=a.mode))
        from dwellrec.operators.metrics import metrics_report
        from dwellrec.session import materialize
        from pyspark.sql import functions as F
        rows = materialize(rows, "metric-rows")
        if a.output:
            rows.write.parquet(a.output)
        ordered = rows.orderBy("rank", "max_iter", "reg_param", "alpha", F.col("split").desc())
        if a.report:
            for r in metrics_report(ordered).collect():     # one row per parameter set and side
                print(f"rank={r.rank} iterations={r.max_iter} lambda={r.reg_param} "
                      f"alpha={r.alpha} [{r.split}] rows={r.rows} negatives={r.negatives}")
                print(r.report, end="")
                print(f"AUC : {r.mean_auc}")
        elif not a.output:
            ordered.show(n=max(1, rows.count()), truncate=False)
    elif a.cmd == "train":
        from dwellrec.plans.jobs import fit_prepared, recommend
        params = _params(argparse.Namespace(**{**vars(a), "rank": [a.rank],
                                               "max_iter": [a.max_iter],
                                               "reg_param": [a.reg_param],
                                               "alpha": [a.alpha]}))[0]
        prep = _prepared(spark, a)
        model = fit_prepared(prep, a.model_dir, params)
        if a.lines:
            recommend(model, prep.user_index, a.n).select("value").write.text(a.lines)
    elif a.parquet:
        from dwellrec.plans.jobs import recommendation_lists
        from dwellrec.sources.model_store import load_store
        model, index, _ = load_store(spark, a.model_dir)
        some = spark.read.parquet(a.visitors) if a.visitors else None
        recommendation_lists(model, index, a.n, some).write.parquet(a.output)
    else:
        from dwellrec.plans.jobs import recommend_from_store
        some = spark.read.parquet(a.visitors) if a.visitors else None
        recommend_from_store(spark, a.model_dir, a.n, some).select("value").write.text(a.output)
    # outputs are written: remove the intermediate tables of this command
    drop_materialized(spark, since=mark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
