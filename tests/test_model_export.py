import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dwellrec.operators import model as als
from dwellrec.operators.export import lines_from_ranked
from dwellrec.plans import jobs as P
from dwellrec.session import scratch_path
from dwellrec.sources.interactions import from_tables
from dwellrec.sources.model_store import load_store, save_store
from dwellrec.sources.sinks import write_text


@pytest.fixture(scope="module")
def trained(spark):
    prep = P.prepare(from_tables(spark, SF_SMALL))
    params = als.AlsParams(rank=5, max_iter=5)
    return prep, params, als.fit(prep.scored, params)


def test_line_layout(spark):
    ranked = spark.createDataFrame([(0, 2, 7, 3), (0, 1, 5, 9)], "user INT, rank INT, item INT, score BIGINT")
    idx = spark.createDataFrame([("vis", 0)], "visitor_trace STRING, user INT")
    assert lines_from_ranked(ranked, idx).first().value == "vis\u0001(5,9);(7,3)"


def test_text_sink_refuses_existing_path(spark):
    lines = spark.createDataFrame([("a",)], "value STRING")
    path = scratch_path(spark, "sink")
    write_text(lines, path)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_text(lines, path)
    write_text(lines, path, mode="overwrite")


def test_same_seed_same_predictions(spark, trained):
    prep, params, model = trained
    again = als.fit(prep.scored, params)
    a = sorted(als.predict_pairs(model, prep.scored).collect())
    b = sorted(als.predict_pairs(again, prep.scored).collect())
    assert [round(x.pred, 5) for x in a] == [round(x.pred, 5) for x in b]


def test_recommendation_lists_descending_and_full(spark, trained):
    prep, _, model = trained
    flat = als.flatten_recommendations(als.recommend_all(model, 10)).collect()
    by_user = {}
    for r in flat:
        by_user.setdefault(r.user, []).append((r.rank, r.rating))
    assert len(by_user) == prep.user_index.count()
    for lst in by_user.values():
        lst.sort()
        assert len(lst) == 10
        assert all(lst[i][1] >= lst[i + 1][1] for i in range(9))


def test_save_reload_keeps_index_and_predictions(spark, trained):
    prep, params, model = trained
    path = scratch_path(spark, "store")
    save_store(path, model, prep.user_index, params.as_dict(), prep.cuts)
    m2, idx2, meta = load_store(spark, path)
    assert meta["rank"] == 5 and meta["cuts"] == prep.cuts
    assert sorted(idx2.collect()) == sorted(prep.user_index.select("visitor_trace", "user").collect())
    a = sorted(als.predict_pairs(model, prep.scored).collect())
    b = sorted(als.predict_pairs(m2, prep.scored).collect())
    assert a == b
    lines = P.recommend(m2, idx2, 10).collect()
    assert all(r.value.startswith(r.visitor_trace + "\u0001") for r in lines)


def test_zero_only_user_gets_zero_predictions(spark):
    rows = [(0, i, 0.0) for i in range(5)] + [(1, i, float(i % 5)) for i in range(5)] + \
           [(2, i, float((i + 1) % 5)) for i in range(5)]
    df = spark.createDataFrame(rows, "user INT, item INT, score DOUBLE")
    m = als.fit(df, als.AlsParams(rank=3, max_iter=5))
    preds = als.predict_pairs(m, df.where(F.col("user") == 0)).collect()
    assert preds and all(abs(p.pred) < 1e-12 for p in preds)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["user", "visitor_trace", "value"]
    assert df.count() > 0


def test_recommend_all_matches_brute_force_factors(spark, trained):
    import numpy as np
    _, _, model = trained
    uf = {r.id: np.array(r.features, dtype=np.float64) for r in model.userFactors.collect()}
    itf = {r.id: np.array(r.features, dtype=np.float64) for r in model.itemFactors.collect()}
    items = sorted(itf)
    mat = np.stack([itf[i] for i in items])
    got = {r.user: [(x.item, x.rating) for x in r.recommendations]
           for r in als.recommend_all(model, 10).collect()}
    assert set(got) == set(uf)
    for u, vec in uf.items():
        scores = mat @ vec
        expect = np.sort(scores)[::-1][:10]
        assert np.allclose([s for _, s in got[u]], expect, atol=1e-4)
        for item, s in got[u]:
            assert abs(scores[items.index(item)] - s) < 1e-4


def test_als_checkpoints_into_session_folder(spark, trained):
    import glob
    from dwellrec.session import checkpoint_root
    root = checkpoint_root(spark).replace("file:", "")
    before = set(glob.glob(root + "/rdd-*"))
    prep, _, _ = trained
    als.fit(prep.scored, als.AlsParams(rank=3, max_iter=4, checkpoint_interval=2))
    assert set(glob.glob(root + "/rdd-*")) - before


def test_frozen_model_predicts_the_same(spark, trained):
    prep, _, model = trained
    frozen = als.freeze(model, spark)
    a = sorted(als.predict_pairs(model, prep.scored).collect())
    b = sorted(als.predict_pairs(frozen, prep.scored).collect())
    assert a == b


def test_prepare_cached_input_gives_same_result(spark):
    a = P.prepare(from_tables(spark, SF_SMALL))
    b = P.prepare(from_tables(spark, SF_SMALL), cache_input=True)
    assert a.cuts == b.cuts and a.n == b.n
    assert sorted(a.scored.collect()) == sorted(b.scored.collect())
    assert sorted(a.user_index.collect()) == sorted(b.user_index.collect())


def test_automatic_blocks_follow_session_and_input(spark):
    scored = spark.createDataFrame([(u, i, 1.0) for u in range(20) for i in range(5)],
                                   "user INT, item INT, score DOUBLE")
    parallelism = spark.sparkContext.defaultParallelism
    assert als.auto_blocks(scored.coalesce(1)) == parallelism
    assert als.auto_blocks(scored.repartition(4 * parallelism + 1, "user", "item")) >= 1
    wide = spark.sparkContext.parallelize(range(100), 4 * parallelism).map(lambda x: (x,)).toDF("x int")
    assert als.auto_blocks(wide) == 2 * parallelism
    for n in (None, -1):
        est = als.make_als(als.AlsParams(num_user_blocks=n, num_item_blocks=n), blocks=als.auto_blocks(wide))
        assert est.getNumUserBlocks() == est.getNumItemBlocks() == 2 * parallelism
    est = als.make_als(als.AlsParams(num_user_blocks=10, num_item_blocks=3), blocks=7)
    assert (est.getNumUserBlocks(), est.getNumItemBlocks()) == (10, 3)
    assert als.AlsParams.for_evaluation().num_user_blocks is None


def test_recommend_needs_no_cross_product(spark, trained):
    """Lists of all users and of some, equal to each other, without Spark ML's cross join."""
    _, _, model = trained
    lists = als.recommend_all(model, 6)
    some = lists.select("user").where("user % 2 = 0")
    part = als.recommend_subset(model, some, 6)
    for df in (lists, part):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert df.schema["recommendations"].dataType.simpleString() == "array<struct<item:int,rating:float>>"
    assert sorted(part.collect()) == sorted(lists.where("user % 2 = 0").collect())
