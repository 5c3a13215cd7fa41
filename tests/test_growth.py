"""What must not grow: values sent to the driver, hot windows; what may: the index."""
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from dwellrec.operators import metrics as M
from dwellrec.operators import ranking
from dwellrec.operators.index import build_user_index, extend_user_index
from dwellrec.plans.crossval import fold_labels, one_standard_error
from dwellrec.sources.interactions import input_fingerprint


def test_split_points_do_not_grow_with_partitions(spark):
    """The driver gets one row a key, of at most n_buckets - 1 numbers."""
    df = spark.range(0, 20000, 1, 400).select((F.col("id") % 7).cast("int").alias("k"), F.col("id").cast("double").alias("v"))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = {}
    try:
        for parts in (4, 400):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            found = ranking.split_points(df, "v", 16, "k")
            assert set(found) == set(range(7))
            sizes[parts] = sum(map(len, found.values()))
            for points in found.values():
                assert points == sorted(points) and all(abs(p - (i + 1) * 1250) < 600 for i, p in enumerate(points))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sizes[4] == sizes[400] == 7 * 15


def test_split_points_of_nothing(spark):
    assert ranking.split_points(spark.createDataFrame([(None,)], "v double"), "v") == {}


@pytest.mark.parametrize("ties", ["wrong", "half"])
def test_hot_buckets_split_again(spark, ties):
    """One user with most rows, buckets split at their own quantiles: same AUC."""
    r = random.Random(3)
    rows = [(u if u else 0, r.randrange(400) / 8, r.randrange(3), r.randrange(3))
            for u in [0] * 900 + [1] * 40 + [2] * 10 for _ in (0,)] + [(0, float("nan"), 2, 1)]
    counts = spark.createDataFrame(rows, "user int, pred double, np long, nn long")
    small = M.auc_from_counts(counts, n_buckets=2, ties=ties, bucket_rows=20)
    large = M.auc_from_counts(counts, n_buckets=2, ties=ties)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    group = M.split_large_groups(ranking.bucketed(counts.where("not isnan(pred)"), "pred", [25.0], "b"), ["user"], "b", "pred", 20)
    most = group.groupBy("user", "b").agg(F.countDistinct("pred").alias("n")).agg(F.max("n")).first()[0]
    assert most <= 20
    order = [x["b"] for x in group.where("user = 0").orderBy("pred").collect()]
    assert order == sorted(order)


def test_folds(spark):
    """Every visitor's items spread evenly, copies of a pair stay together."""
    r = random.Random(1)
    rows = [(0, i % 300) for i in range(1500)] + [(u, r.randrange(50)) for u in range(1, 60) for _ in range(r.randrange(1, 30))]
    df = spark.createDataFrame(rows, "user int, item int").repartition(5)
    got = fold_labels(df, 4).collect()
    assert Counter((x["user"], x["item"]) for x in got) == Counter(rows)
    fold, per = {}, defaultdict(Counter)
    for x in got:
        assert fold.setdefault((x["user"], x["item"]), x["fold"]) == x["fold"]
    for (u, _), f in fold.items():
        per[u][f] += 1
    for c in per.values():
        assert max(c.values()) - min(c.get(f, 0) for f in range(4)) <= 1
    again = {(x["user"], x["item"]): x["fold"] for x in fold_labels(df.repartition(2), 4).collect()}
    assert again == fold
    with pytest.raises(ValueError):
        fold_labels(df, 1)


def test_one_standard_error():
    def p(at, rank, mean, se, reg=1.0):
        return {"point": at, "rank": rank, "max_iter": 5, "reg_param": reg, "auc_mean": mean, "auc_se": se}
    grid = [p(0, 20, .80, .02), p(1, 10, .79, .01), p(2, 5, .77, .01), p(3, 10, .79, .01, 2.0)]
    assert one_standard_error(grid) == 3
    assert one_standard_error([p(0, 5, None, None), p(1, 9, .5, None)]) == 1
    assert one_standard_error([p(0, 5, None, None)]) is None


def test_index_grows_and_keeps_ids(spark):
    first = spark.createDataFrame([("m",), ("c",), ("m",)], "visitor_trace string")
    more = spark.createDataFrame([("a",), ("m",), ("z",), ("a",), (None,)], "visitor_trace string")
    old = build_user_index(first)
    rows = {x["visitor_trace"]: (x["user"], x["n_rows"]) for x in extend_user_index(old, more).collect()}
    assert rows == {"c": (0, 1), "m": (1, 3), "a": (2, 2), "z": (3, 1)}
    none = extend_user_index(old.limit(0), more.limit(0))
    assert none.count() == 0
    assert {x["user"] for x in extend_user_index(old.limit(0), more).collect()} == {0, 1, 2}


def test_fingerprint_is_of_the_rows_alone(spark):
    schema = "visitor_trace string, poi int, rating double"
    rows = [("a", 1, 2.5), ("a", 1, 2.5), (None, 2, None), ("b", None, 1e-7)]

    def of(r, n=1):
        return tuple(input_fingerprint(spark.createDataFrame(r, schema).repartition(n)).first())
    assert of(rows) == of(rows[::-1], 4)
    assert of(rows)[0] == 4
    for other in (rows[:3], rows + rows[:1], [("a", 1, 2.6), *rows[1:]], [("b", 1, 2.5), *rows[1:]]):
        assert of(other) != of(rows)
    assert of([]) == (0, "0", "0")


@pytest.mark.parametrize("most,kind", [(100, "tinyint"), (-129, "smallint"), (1 << 20, "int"), (1 << 40, "bigint")])
def test_joined_vectors_are_narrow(spark, most, kind):
    """Vectors that travel with the pairs take their smallest type; products stay exact BIGINT."""
    from dwellrec.operators import topn
    fac = spark.createDataFrame([(0, [most, 3, 1]), (1, [2, -1, 0])], "id int, q array<bigint>")
    assert topn.narrowed(fac).schema["q"].dataType.elementType.simpleString() == kind
    pairs = spark.createDataFrame([(0, 1), (4, 3), (0, 1), (None, 1)], "user int, item int")
    got = topn.pair_scores(pairs, fac, fac, 2)
    assert got.schema["score"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, got.collect())) == [(0, 1, 2 * most - 3), (4, 3, 2 * most - 3)]
    assert topn.narrowed(fac.limit(0)).count() == 0


def test_small_users_are_one_bucket(spark, monkeypatch):
    """Bucket totals are a row per user, not a row per prediction; nothing stays cached."""
    seen = []
    real = M.running_totals
    monkeypatch.setattr(M, "running_totals", lambda df, part, bucket, *a, **k: (
        seen.append(df.groupBy(*part, bucket).count().count()), real(df, part, bucket, *a, **k))[1])
    rows = [(u, float(p), (u + p) % 2, 1 - (u + p) % 2) for u in range(20) for p in range(40)] + [(3, None, 1, 1)]
    counts = spark.createDataFrame(rows, "user int, pred double, np int, nn int")
    got = M.auc_from_counts(counts)
    assert seen == [20]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, M.auc_from_counts(counts, n_buckets=7).collect()))
    assert all(r.npos == r.nneg == 20 for r in got.collect())
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_fits_leave_nothing_with_the_executors(spark):
    """However many fits a sweep makes, no factors stay cached; a frozen model is not saved again."""
    from dwellrec.operators import model as als
    rows = spark.createDataFrame([(u, i, float((u * i) % 5)) for u in range(9) for i in range(u % 3, 12, 3)],
                                 "user int, item int, score double")
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    models = [als.fit(rows, als.AlsParams(rank=r, max_iter=2)) for r in (2, 3)]
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= before
    assert als.freeze(models[0], spark) is models[0]
    assert [m.rank for m in models] == [2, 3] and models[1].userFactors.count() == 9
    assert "DISK_ONLY" in als.make_als(als.AlsParams()).getFinalStorageLevel()
