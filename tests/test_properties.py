"""Randomised properties (hypothesis) against plain-Python definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dwellrec.operators.ranking import dense_ids, rank_values
from dwellrec.operators.split import hash_split

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.text(alphabet="abcxyz", min_size=0, max_size=4), min_size=1, max_size=300))
def test_dense_ids_equal_sorted_rank(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k STRING").repartition(3)
    got = {r["k"]: r["id"] for r in dense_ids(df, "k", "id").collect()}
    assert got == {k: i for i, k in enumerate(sorted(set(keys)))}


@SETTINGS
@given(st.lists(st.integers(min_value=-5, max_value=5), min_size=5, max_size=400),
       st.integers(min_value=2, max_value=40))
def test_rank_values_equal_sorted_index(spark, values, buckets):
    df = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    n = len(values)
    ranks = sorted({1, n, (n + 1) // 2, max(1, n // 5)})
    out, count = rank_values(df, "v", ranks, n_buckets=buckets)
    s = sorted(values)
    assert count == n
    assert {r["rank"]: r["value"] for r in out.collect()} == {r: float(s[r - 1]) for r in ranks}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=300),
       st.one_of(st.just(0.0), st.floats(min_value=1e-9, max_value=1.0)))
def test_hash_split_is_a_partition(spark, pairs, fraction):
    df = spark.createDataFrame(pairs, "user INT, item INT")
    rows = hash_split(df, fraction).collect()
    assert len(rows) == len(pairs)
    side = {}
    for r in rows:
        assert side.setdefault((r.user, r.item), r.split) == r.split


PRED = st.one_of(st.sampled_from([0.0, 0.5, 1.0, float("nan")]),
                 st.floats(min_value=-2, max_value=2, allow_nan=False))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), PRED), min_size=1, max_size=60),
       st.lists(st.tuples(st.integers(0, 3), PRED), min_size=1, max_size=60))
def test_user_auc_equals_pairwise_definition(spark, pos, neg):
    from dwellrec.operators.metrics import user_auc
    got = {r.user: r.auc for r in user_auc(
        spark.createDataFrame(pos, "user INT, pred DOUBLE"),
        spark.createDataFrame(neg, "user INT, pred DOUBLE")).collect()}
    expect = {}
    for u in {x for x, _ in pos} & {x for x, _ in neg}:
        P = [p for x, p in pos if x == u]
        N = [n for x, n in neg if x == u]
        expect[u] = sum(1 for p in P for n in N if p > n) / (len(P) * len(N))
    assert got == expect


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 14)), min_size=1, max_size=80),
       st.integers(min_value=1, max_value=10**6))
def test_negatives_equal_sequential_definition(spark, positives, seed):
    from dwellrec.operators.negatives import sample_negatives
    from test_negatives import _brute
    items = list(range(0, 30, 2))          # 15 catalogue items, positions 0..14
    positives = [(u, items[i]) for u, i in positives]
    cat = spark.createDataFrame([(it, j) for j, it in enumerate(items)], "item INT, item_ix BIGINT")
    got = sorted(tuple(r) for r in sample_negatives(
        spark.createDataFrame(positives, "user INT, item INT"), cat, len(items), seed).collect())
    assert got == _brute(positives, items, seed)
