"""A visitor holding about a third of all rows (derived from the test tables:
every third customer's lines are relabelled to one visitor)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from dwellrec.operators import metrics as M
from dwellrec.operators.index import attach_user_ids, build_user_index, item_catalogue
from dwellrec.operators.negatives import sample_negatives
from dwellrec.operators.split import hash_split
from dwellrec.functions.exprs import surrogate_pred
from dwellrec.sources.interactions import clean, table, typed


@pytest.fixture(scope="module")
def skewed(spark):
    li = table(spark, SF_SMALL, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    od = table(spark, SF_SMALL, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, SF_SMALL, "customer").select("c_custkey", "c_name")
    j = li.join(od, li.l_orderkey == od.o_orderkey).join(cu, od.o_custkey == cu.c_custkey)
    visitor = F.when(F.col("c_custkey") % 3 == 0, F.lit("HOT")).otherwise(F.col("c_name"))
    return clean(typed(j.select(visitor.alias("v"), "l_partkey", "l_extendedprice"),
                       "v", "l_partkey", "l_extendedprice"))


def _run(skewed, partitions):
    ix = build_user_index(skewed)
    ratings = attach_user_ids(skewed, ix, partitions=partitions)
    lab = hash_split(ratings.withColumnRenamed("rating", "score"))
    cat = item_catalogue(ratings)
    negs = sample_negatives(lab.select("split", "user", "item"), cat, None, by=["split"])
    pos = lab.select("split", "user", surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
    neg = negs.select("split", "user", surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
    auc = M.user_auc(pos, neg, by=["split"], n_buckets=8)
    return (sorted(ratings.collect()), sorted(negs.collect()), sorted(auc.collect()))


def test_hot_visitor_paths_agree(spark, skewed):
    total = skewed.count()
    top = skewed.groupBy("visitor_trace").count().agg(F.max("count")).first()[0]
    assert top * 4 > total                      # the hot visitor holds > 1/4 of rows
    none_hot = _run(skewed, partitions=1)       # threshold = all rows: an empty hot side
    hot = _run(skewed, partitions=64)
    assert none_hot == hot


def test_hot_visitor_plan_uses_broadcasts(spark, skewed):
    ix = build_user_index(skewed)
    df = attach_user_ids(skewed, ix, partitions=64)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_hot_set_is_bounded_by_partitions(spark, skewed):
    from dwellrec.operators.index import hot_threshold
    ix = build_user_index(skewed)
    total = ix.agg(F.sum("n_rows")).first()[0]
    for parts in (2, 8, 64, 512):
        hot = ix.where(F.col("n_rows") > hot_threshold(total, parts)).count()
        assert hot < parts


def test_scale_conf_sizes_partitions():
    from dwellrec.session import scale_conf
    c = scale_conf(100 * 2**40)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    assert int(scale_conf(10 * 2**30)["spark.sql.shuffle.partitions"]) == 40
    assert int(scale_conf(1000)["spark.sql.shuffle.partitions"]) == 8


def test_results_independent_of_partitioning(spark, skewed):
    from dwellrec.plans.jobs import prepare

    def run(parts):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            prep = prepare(skewed)
            lab = hash_split(prep.scored)
            cat = item_catalogue(prep.scored)
            negs = sample_negatives(lab.select("split", "user", "item"), cat, by=["split"])
            pos = lab.select("split", "user",
                             surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
            neg = negs.select("split", "user",
                              surrogate_pred(F.col("user"), F.col("item")).alias("pred"))
            return (sorted(prep.user_index.select("visitor_trace", "user").collect()),
                    prep.cuts, sorted(negs.collect()),
                    sorted(M.user_auc(pos, neg, by=["split"]).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    assert run(3) == run(23)
