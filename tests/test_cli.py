from conftest import SF_SMALL
from dwellrec.__main__ import main
from dwellrec.session import scratch_path


def test_cli_evaluate_train_recommend(spark):
    out = scratch_path(spark, "cli-eval")
    assert main(["evaluate", "--sf-dir", SF_SMALL, "--rank", "3", "4", "--max-iter", "3",
                 "--output", out]) == 0
    rows = spark.read.parquet(out).collect()
    assert sorted((r.rank, r.split) for r in rows) == [(3, "test"), (3, "train"),
                                                        (4, "test"), (4, "train")]
    store, lines, again = (scratch_path(spark, x) for x in ("cli-store", "cli-l1", "cli-l2"))
    assert main(["train", "--sf-dir", SF_SMALL, "--rank", "3", "--max-iter", "3", store,
                 "--lines", lines]) == 0
    assert main(["recommend", store, again]) == 0
    a = sorted(r.value for r in spark.read.text(lines).collect())
    b = sorted(r.value for r in spark.read.text(again).collect())
    assert a == b and len(a) == 150
    pq = scratch_path(spark, "cli-pq")
    assert main(["recommend", store, pq, "--parquet", "--n", "5"]) == 0
    lists = spark.read.parquet(pq).collect()
    assert len(lists) == 150 and all(len(r.recommendations) == 5 for r in lists)
    who, some = scratch_path(spark, "cli-who"), scratch_path(spark, "cli-some")
    visitors = [r.visitor_trace for r in lists][:7]
    spark.createDataFrame([(v,) for v in visitors + visitors[:2] + ["nobody"]],
                          "visitor_trace string").write.parquet(who)
    assert main(["recommend", store, some, "--visitors", who]) == 0
    got = [r.value for r in spark.read.text(some).collect()]
    assert sorted(got) == sorted(x for x in a if x.split("\u0001")[0] in visitors)
    pq = scratch_path(spark, "cli-pq-some")
    assert main(["recommend", store, pq, "--visitors", who, "--parquet", "--n", "4"]) == 0
    assert sorted(r.visitor_trace for r in spark.read.parquet(pq).collect()) == sorted(visitors)


def test_cli_tsv_legacy_path(spark):
    # tab-separated integer ids written from the test tables' ratings
    from dwellrec.plans.catalog import prepared
    src = scratch_path(spark, "tsv-src")
    (prepared(spark, SF_SMALL).ratings.selectExpr("user", "item", "rating")
     .write.csv(src, sep="\t"))
    store, lines = scratch_path(spark, "tsv-store"), scratch_path(spark, "tsv-lines")
    assert main(["train", "--tsv", src, "--shift", "5", "--raw-scores", "--rank", "3",
                 "--max-iter", "3", store, "--lines", lines]) == 0
    assert spark.read.text(lines).count() == 150
    out = scratch_path(spark, "tsv-eval")
    assert main(["evaluate", "--tsv", src, "--rank", "3", "--max-iter", "3",
                 "--output", out]) == 0
    assert spark.read.parquet(out).count() == 2


def test_drop_materialized_removes_intermediates(spark):
    import os
    from dwellrec.session import drop_materialized, materialize, materialized_mark
    keep = materialize(spark.range(5), "kept")
    mark = materialized_mark(spark)
    df = materialize(spark.range(10), "tmp-table")
    path = df.inputFiles()[0].split("/part-")[0].replace("file:", "")
    assert os.path.isdir(path)
    assert drop_materialized(spark, since=mark) == 1
    assert not os.path.exists(path)
    assert keep.count() == 5          # written before the mark: untouched
