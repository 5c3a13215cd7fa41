"""Versioned model store, serving a few visitors, resumed runs, statistics that add up."""
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from dwellrec.operators import model as als
from dwellrec.operators.score import (
    add_sketches,
    dataset_stats,
    overlap_from_sketches,
    stats_from_sketches,
    stats_sketches,
)
from dwellrec.plans import evaluate as E
from dwellrec.plans import jobs as P
from dwellrec.plans import restart
from dwellrec.session import scratch_path
from dwellrec.sources import model_store
from dwellrec.sources.interactions import from_tables
from dwellrec.sources.model_store import load_store, save_store, versions


@pytest.fixture(scope="module")
def prep(spark):
    return P.prepare(from_tables(spark, SF_SMALL))


def small_model(prep, rank):
    return als.fit(prep.scored, als.AlsParams(rank=rank, max_iter=1))


def test_versions_replace_each_other(spark, prep):
    path = scratch_path(spark, "store")
    for rank in (2, 3, 4):
        save_store(path, small_model(prep, rank), prep.user_index, {"rank": rank}, prep.cuts,
                   "overwrite" if rank > 2 else "errorifexists")
        model, index, meta = load_store(spark, path)
        assert (model.rank, meta["rank"], index.count()) == (rank, rank, prep.user_index.count())
    assert len(versions(spark, path)) == 2 and load_store(spark, path, 2)[2]["rank"] == 3
    with pytest.raises(FileNotFoundError):
        load_store(spark, path, 1)
    with pytest.raises(FileExistsError):
        save_store(path, model, prep.user_index, {}, prep.cuts)
    with pytest.raises(FileNotFoundError):
        load_store(spark, scratch_path(spark, "nothing"))


@pytest.mark.parametrize("dies_at", ["params", "marker", "index"])
def test_a_writer_that_dies_leaves_the_old_version(spark, prep, monkeypatch, dies_at):
    path = scratch_path(spark, "store")
    save_store(path, small_model(prep, 2), prep.user_index, {"rank": 2}, prep.cuts)

    def die(*a, **k):
        raise RuntimeError("killed")

    index = prep.user_index
    if dies_at == "marker":
        monkeypatch.setattr(model_store, "mark", die)
    elif dies_at == "params":
        monkeypatch.setattr(model_store.json, "dumps", die)
    else:
        index = index.withColumn("visitor_trace", F.raise_error(F.lit("killed")))
    with pytest.raises(Exception, match="killed"):
        save_store(path, small_model(prep, 5), index, {"rank": 5}, prep.cuts, "overwrite")
    monkeypatch.undo()
    model, _, meta = load_store(spark, path)
    assert model.rank == meta["rank"] == 2
    save_store(path, small_model(prep, 3), prep.user_index, {"rank": 3}, prep.cuts, "overwrite")
    assert load_store(spark, path)[2]["rank"] == 3


def test_store_knows_its_input(spark):
    path = scratch_path(spark, "store")
    inter = from_tables(spark, SF_SMALL)
    P.train(inter, path, als.AlsParams(rank=2, max_iter=1), record_input=True)
    meta = load_store(spark, path)[2]
    assert P.same_input(meta, inter.repartition(3)) and not P.same_input(meta, inter.where("poi <> 1"))
    with pytest.raises(ValueError):
        P.same_input({"rank": 2}, inter)


def scanned_rows(df, folder):
    """Rows that the scans of ``folder`` put out when ``df`` runs."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan()
        plan.execute().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    leaves = [plan.collectLeaves().apply(i) for i in range(plan.collectLeaves().size())]
    return sum(x.metrics().apply("numOutputRows").value() for x in leaves
               if x.nodeName().startswith("Scan parquet") and folder in x.relation().location().rootPaths().toString())


def test_serving_few_visitors_reads_few_factors(spark):
    """Factors of 40,000 users in sorted files; three visitors need a part of them."""
    n, path = 40_000, scratch_path(spark, "store")
    rows = spark.range(n).select(F.col("id").cast("int").alias("user"), (F.col("id") % 50).cast("int").alias("item"),
                                 F.lit(1.0).alias("score"))
    model = als.fit(rows, als.AlsParams(rank=2, max_iter=1))
    index = rows.select(F.format_string("v%06d", "user").alias("visitor_trace"), "user")
    save_store(path, model, index, {}, [])
    model, index, _ = load_store(spark, path)
    some = spark.createDataFrame([(17,), (18,), (31000,)], "user int")
    near = als.near_ids(some)
    assert als.id_ranges(some) == [(17, 18), (31000, 31000)]
    lists = als.recommend_subset(model, near, 5)
    assert {r.user for r in lists.collect()} == {17, 18, 31000}
    assert 0 < scanned_rows(lists, "userFactors") < n
    assert scanned_rows(als.recommend_subset(model, some, 5), "userFactors") == n
    a, b = (sorted((r.user, r.value) for r in P.recommend_from_store(spark, path, 5, v).collect())
            for v in (None, spark.createDataFrame([("v000017",), ("v031000",), ("nobody",), ("v000017",)],
                                                  "visitor_trace string")))
    assert b == [x for x in a if x[0] in (17, 31000)]


def test_id_ranges(spark):
    r = random.Random(5)
    for n, ranges in ((1, 1), (40, 3), (300, 64), (5000, 7)):
        ids = sorted({r.randrange(-10**6, 10**6) for _ in range(n)})
        got = als.id_ranges(spark.createDataFrame([(i,) for i in ids], "user int"), ranges, 512)
        assert len(got) <= ranges and all(any(a <= i <= b for a, b in got) for i in ids)
        assert all(a <= b for a, b in got) and all(x[1] < y[0] for x, y in zip(got, got[1:]))
    assert als.id_ranges(spark.createDataFrame([], "user int")) == []
    assert als.near_ids(spark.createDataFrame([], "user int")).count() == 0


def rounded(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_sweep_resumes_after_a_death(spark, monkeypatch):
    inter = from_tables(spark, SF_SMALL)
    grid = [als.AlsParams.for_evaluation(rank=r, max_iter=2) for r in (2, 3)]
    folder = scratch_path(spark, "run")
    calls, real, prepares = [], E._evaluate_model, []

    def watched(shared, params, threshold):
        calls.append(params.rank)
        if params.rank == 3 and len(calls) == 2:
            raise RuntimeError("killed")
        return real(shared, params, threshold)

    monkeypatch.setattr(E, "_evaluate_model", watched)
    monkeypatch.setattr(restart, "build_user_index",
                        lambda i, f=restart.build_user_index: prepares.append(1) or f(i))
    with pytest.raises(RuntimeError, match="killed"):
        restart.sweep(inter, grid, folder)
    got = restart.sweep(inter, grid, folder)
    assert calls == [2, 3, 3] and prepares == [1]
    assert rounded(got) == rounded(E.sweep(inter, grid))
    assert len(rounded(restart.sweep(inter, grid[:1], folder))) == 2 and calls == [2, 3, 3, 2, 3]
    restart.sweep(inter.where("poi <> 1"), grid[:1], folder)          # another input: another run
    assert prepares == [1, 1] and calls[-1] == 2 and len(calls) == 6


def test_unfinished_stage_is_written_anew(spark):
    stages = restart.Stages(spark, scratch_path(spark, "run"), restart.table_fingerprint(spark.range(3)), {})
    spark.range(5).write.parquet(f"{stages.at}/a")                     # files, but no marker
    assert not stages.done("a")
    assert stages.table("a", lambda: spark.range(7)).count() == 7 and stages.done("a")
    assert stages.table("a", lambda: spark.range(9)).count() == 7


def test_table_fingerprint(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, `a.b` string")
    f = restart.table_fingerprint(df)
    assert f == restart.table_fingerprint(df.orderBy(F.desc("x")).repartition(3)) and f["rows"] == 3
    assert f != restart.table_fingerprint(df.distinct()) != restart.table_fingerprint(df.limit(0))


def test_sketches_add_up(spark):
    rows = spark.range(30_000).select((F.col("id") % 7001).cast("int").alias("user"), (F.col("id") % 90).cast("int").alias("item"),
                                      (F.col("id") % 5).cast("int").alias("day"))
    kept = stats_sketches(rows.where("day < 4"), ["day"])
    kept = add_sketches(kept, stats_sketches(rows.where("day >= 3"), ["day"]), ["day"])     # day 3 twice
    got, exact = stats_from_sketches(kept).first(), dataset_stats(rows).first()
    assert got == exact                                      # below 2^14 values a sketch is exact
    small = stats_from_sketches(stats_sketches(rows, ["day"], lg=8), lg=8).first()
    assert small["ratings"] == 30_000 and abs(small["users"] - 7001) < 5 * 7001 / 16 and small["items"] == 90
    common = overlap_from_sketches(kept, "day", 0, 1).first()
    a, b = (rows.where(f"day = {d}") for d in (0, 1))
    assert common["users"] == a.select("user").intersect(b.select("user")).count()
    assert common["items"] == a.select("item").intersect(b.select("item")).count() == 0
    assert stats_from_sketches(kept, ["day"]).count() == 5
    assert overlap_from_sketches(kept.limit(0), "day", 0, 1).first()["users"] in (None, 0)
