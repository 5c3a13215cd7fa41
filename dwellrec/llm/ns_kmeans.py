"""Centroid clustering (Lloyd's rounds) with ns-bounds.

Vectors are integers (floor(scale * x)), so every assignment, sum and centroid is
exact. For each vector and centroid the last computed distance is kept with its
round. All earlier centroids stay in memory (rounds x k vectors); a stored distance
to centroid j is loosened by how far j lies now from where it was *then* (the norm
of its total displacement), not by the sum of its steps since, which is never
smaller. Only where the loosened interval of a centroid still reaches that of the
assigned one, distances are computed again, exactly, in integers.

State (vector, cluster, distances, rounds) is one Parquet table a round in the
shared folder, written from the one before by an Arrow pass and replacing it, so a
lost executor repeats a task and not the rounds. Cluster sums change by the vectors
that moved: partial sums per task, k rows each, meet by cluster and component; k
centroids reach the driver.

Bounds are floating, with a margin above their rounding error; integers beyond
±2^27 (a squared distance might pass 63 bits) raise an error. Defined results:
vectors that are null, of another length, or hold null or non-finite components are
left out; null ids are kept (as starting points they come last); rows alike stay
separate rows; fewer vectors than k give as many clusters; empty clusters keep their
centroid; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import quoted
from dwellrec.session import discard, materialize, scratch_path, track_materialized

CLUSTERS, ROUNDS, DIM, SCALE = 8, 10, 64, 1024
LIMIT = 1 << 27
MARGIN = 1e-9          # relative; float64 distances of such integers are good to 1e-14
_STATE = "vec_id {}, q binary, was int, cluster int, seen binary, at binary, distance long, computed int"


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str, dim: int, scale: int) -> DataFrame:
    """(vec_id, q): the vectors that take part, as int64 bytes."""
    v = quoted(embedding)
    inf = F.lit(float("inf"))
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    src = vectors.select(quoted(vec_id).alias("vec_id"), v.cast("array<double>").alias("v")).where(
        v.isNotNull() & (F.size(v) == dim) & fine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.floor(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) * scale)
            if len(x) and np.abs(x).max() > LIMIT:
                raise ValueError(f"a component beyond {LIMIT // scale} cannot be clustered exactly")
            rows = x.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([r.tobytes() for r in rows], pa.binary())], names=["vec_id", "q"])

    kind = src.schema["vec_id"].dataType.simpleString()
    return src.mapInArrow(run, f"vec_id {kind}, q binary")


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the least sha256 of ``seed:vec_id``, in that order."""
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    least = rows.orderBy(mark.asc_nulls_last(), "q").limit(k).collect()
    return np.array([np.frombuffer(r["q"], dtype="<i8") for r in least], dtype=np.int64)


def reassign(x: np.ndarray, cluster: np.ndarray, seen: np.ndarray, at: np.ndarray, past: np.ndarray):
    """One round for some vectors: x (n, dim) integers, their cluster (-1 before the
    first round), seen (n, k) distances computed in the rounds at (n, k), and past
    (rounds so far, k, dim), the last one current. Returns (cluster, seen, at,
    squared distances computed); ties go to the smaller number."""
    n, k = seen.shape
    now, t = past[-1], len(past) - 1
    cluster, seen, at = cluster.copy(), seen.copy(), at.copy()
    everyone, computed = np.arange(n), np.zeros(n, dtype=np.int32)
    exact = np.full((n, k), -1, dtype=np.int64)       # squared, where computed in this round

    def compute(rows, j):
        d = x[rows] - now[j]
        exact[rows, j] = (d * d).sum(axis=1)
        seen[rows, j] = np.sqrt(exact[rows, j].astype(np.float64))
        at[rows, j] = t
        computed[rows] += 1

    def reach(low_too=True):
        moved = np.linalg.norm((past - now).astype(np.float64), axis=2)      # (rounds, k)
        off = moved[at, np.arange(k)]
        slack = MARGIN * (seen + off) + MARGIN
        return seen - off - slack, seen + off + slack

    if t == 0 or (cluster < 0).any():
        for j in range(k):
            compute(everyone, j)
    else:
        low, high = reach()
        mine = high[everyone, cluster]
        open_ = low <= mine[:, None]
        open_[everyone, cluster] = False
        rows = np.flatnonzero(open_.any(axis=1))
        for j in range(k):                            # the assigned centroid first
            compute(rows[cluster[rows] == j], j)
        low, high = reach()
        mine = high[everyone, cluster]
        open_[rows] &= low[rows] <= mine[rows, None]
        for j in range(k):
            compute(np.flatnonzero(open_[:, j]), j)
    done = np.where(exact < 0, np.iinfo(np.int64).max, exact)
    some = (exact >= 0).any(axis=1)
    cluster[some] = done[some].argmin(axis=1)         # the first of equal ones
    return cluster, seen, at, computed


def _pass(state: DataFrame, past: np.ndarray, last: bool) -> DataFrame:
    """The state after one more assignment; the last one computes distances."""
    k, dim = past.shape[1:]
    schema = _STATE.format(state.schema["vec_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            x, seen, at = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=kind).reshape(n, -1)
                           for c, kind in (("q", "<i8"), ("seen", "<f8"), ("at", "u1")))
            was = b.column("cluster").to_numpy()
            cluster, seen, at, computed = reassign(x, was, seen.reshape(n, k), at.reshape(n, k), past)
            dist = np.zeros(n, dtype=np.int64)
            if last:
                d = x - past[-1][cluster]
                dist = (d * d).sum(axis=1)
            rows = pa.binary()
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("q"), pa.array(was, pa.int32()), pa.array(cluster, pa.int32()),
                 pa.array([r.tobytes() for r in seen.astype("<f8")], rows),
                 pa.array([r.tobytes() for r in at.astype("u1")], rows),
                 pa.array(dist), pa.array(computed)],
                names=["vec_id", "q", "was", "cluster", "seen", "at", "distance", "computed"])

    return state.select("vec_id", "q", "cluster", "seen", "at").mapInArrow(run, schema)


def _moved(state: DataFrame, k: int, dim: int):
    """(counts, sums) by which the clusters changed: exact Python integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dim), dtype=np.int64)
        for b in batches:
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), dtype="<i8").reshape(-1, dim)
            was, now = (b.column(i).to_numpy() for i in (1, 2))
            for side, sign in ((was, -1), (now, 1)):
                held = side >= 0
                np.add.at(count, side[held], sign)
                for j in np.unique(side[held]):
                    total[j] += sign * x[side == j].sum(axis=0)
        some = np.flatnonzero(count.astype(bool) | total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([[int(count[j]), *total[j].tolist()] for j in some],
                                                  pa.list_(pa.int64()))], names=["cluster", "v"])

    parts = state.where("was <> cluster").select("q", "was", "cluster").mapInArrow(
        run, "cluster int, v array<long>")
    sums = parts.select("cluster", F.posexplode("v").alias("i", "v")).groupBy("cluster", "i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [[0] * (dim + 1) for _ in range(k)]
    for r in sums.collect():                          # k x (dim + 1) numbers
        out[r["cluster"]][r["i"]] = int(r["v"])
    return out


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE,
            seed: int = 3, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256; one row
    per vector that takes part."""
    spark = vectors.sparkSession
    rows = materialize(integer_vectors(vectors, vec_id, embedding, dim, scale), "integer-vectors")
    now = first_centroids(rows, k, seed)
    k = len(now)
    if not k:
        none = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, {none}")
    past, sums, old = now[None], [[0] * (dim + 1) for _ in range(k)], None
    state = rows.select("vec_id", "q", F.lit(-1).alias("cluster"), F.unhex(F.lit("00" * 8 * k)).alias("seen"),
                        F.unhex(F.lit("00" * k)).alias("at"))
    for t in range(rounds + 1):
        path = scratch_path(spark, f"kmeans-{t}")
        _pass(state, past, t == rounds).write.parquet(path)
        track_materialized(spark, path)
        state = spark.read.parquet(path)
        if old:
            discard(spark, old)
        old = path
        if t < rounds:
            sums = [[a + b for a, b in zip(*two)] for two in zip(sums, _moved(state, k, dim))]
            now = np.array([[s // c[0] for s in c[1:]] if c[0] else past[-1][j].tolist()
                            for j, c in enumerate(sums)], dtype=np.int64)
            past = np.concatenate([past, now[None]])
    inertia = state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in inertia)
    ends = [(r["cluster"], r["d"], total, hashlib.sha256(",".join(map(str, past[-1][r["cluster"]].tolist()))
                                                         .encode()).hexdigest()) for r in inertia]
    ends = spark.createDataFrame(ends, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(ends), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def cluster_sql(vectors: str = "embeddings", k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM,
                scale: int = SCALE, seed: int = 3) -> str:
    """The same in DuckDB: plain Lloyd's rounds."""
    out = [f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding,
    lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM {vectors}
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, q) - 1
    AS INTEGER) AS j, q AS c FROM v ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, q LIMIT {k})"""]
    for t in range(rounds + 1):
        out.append(f"""
a{t} AS MATERIALIZED (SELECT rid, vec_id, q, j, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, j)
    AS pick FROM (SELECT v.*, j, list_sum(list_transform(range(1, {dim + 1}),
      lambda i: (q[i] - c[i]) * (q[i] - c[i])))::BIGINT AS d FROM v CROSS JOIN c{t})) WHERE pick = 1)""")
        if t < rounds:
            out.append(f"""
s{t} AS (SELECT j, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM
  (SELECT j, unnest(q) AS x, unnest(range(1, {dim + 1})) AS i FROM a{t}) GROUP BY ALL),
m{t} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{t} GROUP BY j),
c{t + 1} AS MATERIALIZED (SELECT c{t}.j, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (j))""")
    return ",".join(out) + f"""
SELECT vec_id, j AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (j)
"""
