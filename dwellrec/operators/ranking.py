"""Exact global ranking without a single-partition window.

* ``dense_ids``   — 0-based dense id in ascending key order (``row_number()
  over (order by key) - 1`` on distinct keys). Range-partitioned sort, frozen
  with the partition positions as a Parquet table in the shared folder, then
  per-partition offsets. Only one count per partition reaches the driver.
* ``rank_values`` — the values at given 1-based ranks of a numeric column
  (ties allowed). Bucket counts over approximate quantiles locate the ranks;
  the buckets holding them are cut again until each is small or holds a single
  value, and only those are sorted, with equal values collapsed first, so a
  value held by a third of all rows is one row.
* ``running_totals`` — per-group prefix sums in a numeric order, in two levels
  (bucket totals, then within-bucket windows) so no window partition holds a
  whole hot group.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dwellrec.session import materialize

N_BUCKETS = 256
# a bucket of at most this many rows is sorted by one task
SORT_ROWS = 1 << 20


def dense_ids(df: DataFrame, key: str, id_col: str = "id",
              aggs: Sequence = ()) -> DataFrame:
    """Distinct non-null ``key`` values with a dense 0-based BIGINT id in
    ascending key order, plus optional per-key aggregates.

    The keys are range-partitioned and sorted; each row's partition id and
    position within its partition are taken right after the sort and written
    with it as a Parquet table in the shared checkpoint folder, so they are
    frozen: a lost executor re-reads files, and every later read gives each
    key the same id (a retried write task recomputes the same values, since
    the sorted keys are distinct). Rows per partition are then counted from
    the small ``_p`` column alone.
    """
    base = df.where(F.col(key).isNotNull())
    keys = base.groupBy(key).agg(*aggs) if aggs else base.select(key).distinct()
    cols = keys.columns
    ordered = keys.orderBy(key).select(
        *cols, F.spark_partition_id().alias("_p"), F.monotonically_increasing_id().alias("_m"))
    frozen = materialize(ordered, "dense-keys")
    counts = {r["_p"]: r["count"] for r in frozen.groupBy("_p").count().collect()}
    # one start offset per partition (size bound = partitions), passed as one
    # JSON literal that constant folding turns into an array literal
    offsets, acc = [], 0
    for p in range(max(counts) + 1 if counts else 0):
        offsets.append(acc)
        acc += int(counts.get(p, 0))
    start = F.element_at(F.from_json(F.lit(json.dumps(offsets or [0])), "array<bigint>"),
                         F.col("_p") + 1)
    local = F.col("_m") - F.shiftleft(F.col("_p").cast("bigint"), 33)
    return frozen.select(*cols, (start + local).alias(id_col))


def split_points(df: DataFrame, col: str, n_buckets: int = N_BUCKETS,
                 by: str | None = None) -> dict[int, list[float]]:
    """Approximate quantiles of ``col``, per value of the small INT column
    ``by`` (0 without one).

    Any increasing values serve as split points, so mergeable sketches of fixed
    size do: one per task and key, merged in two levels (about the root of the
    partition count in each), so no task merges them all and the driver receives
    at most n_buckets - 1 numbers a key, whatever the partition count."""
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, n_buckets)])
    groups = math.isqrt(max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    key = F.col(by) if by else F.lit(0)
    size = F.lit(min(65535, max(256, 4 * n_buckets)))
    value = F.col(col).cast("double")
    # the group is that of the task: Spark merges a task's rows before the shuffle
    part = (df.where(value.isNotNull())
            .groupBy(key.alias("_k"), (F.spark_partition_id() % F.lit(groups)).alias("_g"))
            .agg(F.kll_sketch_agg_double(value, size).alias("s")))
    met = part.groupBy("_k").agg(F.kll_merge_agg_double("s").alias("s"))
    found = met.select("_k", F.kll_sketch_get_quantile_double("s", probs).alias("q")).collect()
    return {r["_k"]: sorted({x for x in r["q"] or [] if x is not None}) for r in found}


def bucketed(df: DataFrame, col: str, points: Sequence[float], out: str = "_b") -> DataFrame:
    """Add ``out``: the number of the interval between ``points`` (strictly
    increasing) that holds ``col``; NaN lies above all."""
    splits = [float("-inf"), *(points or [0.0]), float("inf")]
    return Bucketizer(splits=splits, inputCol=col, outputCol=out,
                      handleInvalid="keep").transform(df)


def rank_values(df: DataFrame, col: str, ranks: Sequence[int] | None = None,
                n_buckets: int = N_BUCKETS, rank_fn=None,
                sort_rows: int = SORT_ROWS) -> tuple[DataFrame, int]:
    """Values at 1-based ``ranks`` of ``col`` in ascending order (with ties).

    ``rank_fn(n)`` may compute the ranks from the row count instead.
    Returns (DataFrame[k INT, rank BIGINT, value DOUBLE], n).

    Every split point is paired with the next larger double, so a frequent
    value gets a bucket of its own and each round shrinks the others. Driver
    data: the points and one count per bucket.
    """
    spark = df.sparkSession
    # NULL and NaN have no rank here (callers drop them at ingest)
    vals = (df.select(F.col(col).cast("double").alias("v"))
            .where(F.col("v").isNotNull() & ~F.isnan(F.col("v"))))
    points: set[float] = set()
    open_ = {float("-inf"): float("inf")}          # intervals [lo, hi) to cut again
    n = None
    while True:
        inside = F.lit(None).cast("int")
        for i, (lo, hi) in enumerate(open_.items()):
            inside = F.when((F.col("v") >= lo) & ((F.col("v") < hi) | F.lit(hi == float("inf"))),
                            F.lit(i)).otherwise(inside)
        fresh = split_points(vals.withColumn("_i", inside).where("_i is not null"), "v",
                             n_buckets, "_i")
        for found in fresh.values():
            for x in found:
                points |= {x, math.nextafter(x, math.inf)}
        cuts = sorted(x for x in points if math.isfinite(x))
        counts = {int(r["_b"]): int(r["c"]) for r in bucketed(vals, "v", cuts)
                  .groupBy("_b").agg(F.count(F.lit(1)).alias("c")).collect()}
        if n is None:
            n = sum(counts.values())
            ranks = [int(r) for r in (rank_fn(n) if rank_fn is not None else ranks)]
            for r in ranks:
                if r < 1 or r > n:
                    raise ValueError(f"rank {r} out of range for {n} rows")
        edges = [float("-inf"), *(cuts or [0.0]), float("inf")]
        targets, below, todo = [], 0, dict(enumerate(ranks, start=1))
        for b in sorted(counts):
            for k, r in list(todo.items()):
                if r <= below + counts[b]:
                    targets.append((k, r, b, r - below))
                    del todo[k]
            below += counts[b]
        large = {edges[b]: edges[b + 1] for _, _, b, _ in targets
                 if counts[b] > sort_rows and math.nextafter(edges[b], math.inf) < edges[b + 1]}
        if not large or large == open_:
            break
        open_ = large
    # a bucket between a double and the next one holds that value alone
    known = [(k, r, edges[b]) for k, r, b, _ in targets
             if math.nextafter(edges[b], math.inf) >= edges[b + 1]]
    rest = [t for t in targets if t[0] not in {k for k, _, _ in known}]
    schema = "k int, rank bigint, value double"
    out = spark.createDataFrame(known, schema)
    if rest:
        wanted = sorted({float(b) for _, _, b, _ in rest})
        cand = (bucketed(vals, "v", cuts).where(F.col("_b").isin(wanted))
                .groupBy("_b", "v").agg(F.count(F.lit(1)).alias("c")))
        w = Window.partitionBy("_b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        cand = cand.withColumn("_cum", F.sum("c").over(w))
        # the value at local rank r of bucket b is the row whose cumulative count
        # first reaches r; a row may answer several targets (ties), so the hits
        # are an array of (k, rank) structs, exploded
        hits = F.array(*[
            F.when((F.col("_b") == F.lit(float(b))) & (F.col("_cum") >= F.lit(loc))
                   & (F.col("_cum") - F.col("c") < F.lit(loc)),
                   F.struct(F.lit(k).cast("int").alias("k"), F.lit(r).cast("bigint").alias("rank")))
            for k, r, b, loc in rest])
        out = out.unionByName(
            cand.select(F.explode(F.filter(hits, lambda x: x.isNotNull())).alias("t"), "v")
            .select("t.k", "t.rank", F.col("v").alias("value")))
    return out, n


def running_totals(df: DataFrame, part: Sequence[str], bucket: str, order: str,
                   values: Sequence[str], inclusive: bool = False) -> DataFrame:
    """Add ``<v>_run`` = sum of ``v`` over rows of the same ``part`` that come
    before this row in (``bucket``, ``order``) order (``inclusive`` adds the row
    itself). ``bucket`` must be non-decreasing in ``order`` within a part.

    Level 1: per (part, bucket) totals, then a window over the buckets of a
    part (at most #buckets rows per part). Level 2: a window inside each
    (part, bucket). No window partition holds a whole hot part.
    """
    part = list(part)
    totals = df.groupBy(*part, bucket).agg(*[F.sum(v).alias(f"_{v}_bt") for v in values])
    wb = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*part, bucket, *[
        F.coalesce(F.sum(f"_{v}_bt").over(wb), F.lit(0)).alias(f"_{v}_bb") for v in values])
    hi = 0 if inclusive else -1
    wi = Window.partitionBy(*part, bucket).orderBy(order).rowsBetween(Window.unboundedPreceding, hi)
    inner = df.select("*", *[F.coalesce(F.sum(v).over(wi), F.lit(0)).alias(f"_{v}_bi")
                             for v in values])
    out = inner.join(totals, part + [bucket])
    return out.select(*df.columns, *[
        (F.col(f"_{v}_bb") + F.col(f"_{v}_bi")).alias(f"{v}_run") for v in values])
