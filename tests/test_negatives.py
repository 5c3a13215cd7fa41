import random

from pyspark.sql import functions as F

from dwellrec.operators.negatives import sample_negatives


P = 2147483579


def _cube(x):
    return x * x % P * x % P


def _mix(a, b, seed):
    start = _cube((a * 7919 + seed) % P)
    return _cube((start + b * (_cube((start + 104729) % P) + 1)) % P)


def _brute(positives, items, seed):
    n = len(items)
    out = []
    by_user = {}
    for u, i in positives:
        by_user.setdefault(u, set()).add(i)
    for u, pos in by_user.items():
        acc = []
        for d in range(1, n + 1):
            if len(acc) >= len(pos):
                break
            item = items[_mix(u, d, seed) % n]
            if item not in pos:
                acc.append((u, item, d))
        out += acc
    return sorted(out)


def test_negatives_match_sequential_definition(spark):
    rnd = random.Random(11)
    items = sorted(rnd.sample(range(1000), 60))
    positives = [(u, rnd.choice(items)) for u in range(30) for _ in range(rnd.randrange(1, 40))]
    positives += [(99, i) for i in items]            # owns every item: no negatives
    positives += [(98, i) for i in items[:-1]]       # one item left: heavy rejection
    pos_df = spark.createDataFrame(positives, "user INT, item INT")
    cat = spark.createDataFrame([(i, j) for j, i in enumerate(items)], "item INT, item_ix BIGINT")
    got = sorted(tuple(r) for r in sample_negatives(pos_df, cat, len(items), seed=3).collect())
    assert got == _brute(positives, items, 3)
    assert not [g for g in got if g[0] == 99]
    pos_set = set(positives)
    assert all((u, i) not in pos_set for u, i, _ in got)


def test_negatives_grouped_by_split(spark):
    items = list(range(10))
    rows = [("a", 1, 1), ("a", 1, 2), ("b", 1, 3)]
    pos_df = spark.createDataFrame(rows, "split STRING, user INT, item INT")
    cat = spark.createDataFrame([(i, i) for i in items], "item INT, item_ix BIGINT")
    got = sample_negatives(pos_df, cat, 10, seed=1, by=["split"])
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"a": 2, "b": 1}
    a_items = [r.item for r in got.where(F.col("split") == "a").collect()]
    assert 1 not in a_items and 2 not in a_items


def test_negatives_in_small_chunks(spark, monkeypatch):
    import dwellrec.operators.negatives as N
    monkeypatch.setattr(N, "DRAW_CHUNK", 7)
    rnd = random.Random(12)
    items = sorted(rnd.sample(range(500), 40))
    positives = [(u, rnd.choice(items)) for u in range(10) for _ in range(rnd.randrange(1, 30))]
    positives += [(50, i) for i in items[:38]]        # few draws accepted: several passes
    pos_df = spark.createDataFrame(positives, "user INT, item INT")
    cat = spark.createDataFrame([(i, j) for j, i in enumerate(items)], "item INT, item_ix BIGINT")
    got = sorted(tuple(r) for r in sample_negatives(pos_df, cat, len(items), seed=5).collect())
    assert got == _brute(positives, items, 5)


def test_short_users_are_completed(spark, monkeypatch):
    """A first budget of two draws: every user needs more passes, and gets the
    draws of one long run."""
    import dwellrec.operators.negatives as N
    monkeypatch.setattr(N, "_budget", lambda n: F.lit(2).cast("bigint"))
    rnd = random.Random(14)
    items = list(range(200))
    positives = [(u, rnd.choice(items)) for u in range(5) for _ in range(60)]
    cat = spark.createDataFrame([(i, i) for i in items], "item INT, item_ix BIGINT")
    got = sorted(tuple(r) for r in sample_negatives(
        spark.createDataFrame(positives, "user INT, item INT"), cat, 200, seed=2).collect())
    assert got == _brute(positives, items, 2)


def test_users_do_not_share_draws(spark):
    """No user's sequence is a shifted copy of another's."""
    from dwellrec.functions.exprs import mix
    draws = spark.range(1, 400).select(*[
        mix(F.lit(u), F.col("id"), 7).alias(f"u{u}") for u in (5, 5 + 104729, 6)]).collect()
    runs = [{tuple(r[c] for r in draws[i:i + 3]) for i in range(390)} for c in range(3)]
    assert not runs[0] & runs[1] and not runs[0] & runs[2]
    assert len({r[0] for r in draws}) == len(draws)      # one-to-one over the draws
    shifted = spark.range(8000, 8400).select(mix(F.lit(5), F.col("id"), 7).alias("x"))
    assert not {r["x"] for r in shifted.collect()} & {r[1] for r in draws}


def test_negatives_exclude_known_items(spark):
    items = list(range(20))
    rows = [("test", 1, 3)]
    known = [(1, i) for i in range(0, 20, 2)]          # even items are known
    cat = spark.createDataFrame([(i, i) for i in items], "item INT, item_ix BIGINT")
    got = sample_negatives(spark.createDataFrame(rows, "split STRING, user INT, item INT"),
                           cat, 20, seed=4, by=["split"],
                           exclude=spark.createDataFrame(known, "user INT, item INT")).collect()
    assert len(got) == 1 and got[0].item % 2 == 1 and got[0].item != 3
