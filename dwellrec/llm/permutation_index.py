"""Approximate nearest neighbours by a permutation index.

A vector is represented by its ``KEEP`` nearest pivots in order of nearness. The
index keeps, for blocks of about ``BLOCK`` vectors, one inverted file: per pivot the
vectors that hold it, with its place in their order. A query ranks its own nearest
pivots, walks only their lists and adds up, for every vector met, the part of
Spearman's footrule that shared pivots save (a pivot missing on one side counts as
placed behind all others). The best ``SHARE`` of each block (``AT_LEAST`` at least)
by footrule distance are reranked by the Euclidean distance of the original vectors
in double precision. The share grows with the block, so no fixed number of
candidates caps a large table.

Pivots are a sample of ``PIVOTS`` distinct vectors of each length (the smallest
hashes); every vector is indexed. Equal vectors are one entry: of a class only the
11 smallest ids can stand in any list of 10, so a class of any size costs 11 ids,
and a query vector is searched once however many rows hold it. Queries are searched
in chunks of about ``CHUNK`` vectors; one packed chunk at a time is broadcast (a few
MB whatever the table), and each task scans its blocks once per chunk.

Measured recall of the 10 nearest against brute force: README and tests.

Defined results: vectors that are null, empty, all zero, or hold null or non-finite
components take no part, nor do rows with a null id; vectors are compared with those
of equal length only; rows alike in id and vector are one row, and no candidate of
themselves; an id with several vectors is that many rows (and queries); ties go to
the smaller id; fewer candidates than asked give a shorter list; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellrec.llm.common import join_groups, quoted
from dwellrec.session import materialize, scratch_path, track_materialized

PIVOTS, KEEP = 256, 128
SHARE, AT_LEAST = 0.05, 512
NEAREST = 10
BLOCK, CHUNK = 8192, 16384
_ROWS = 65536                  # local numbers of a block are 16 bits wide


def _taking_part(v: Column) -> Column:
    inf = F.lit(float("inf"))
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def vector_classes(vectors: DataFrame, vec_id: str, embedding: str, most: int):
    """(rows, classes): rows (k, id) of all distinct (vector, id), classes (k, dim, v,
    ids, n) one per distinct vector with its ``most`` smallest ids and its rows; k is
    a 128-bit key of the vector."""
    src = vectors.select(quoted(vec_id).cast("bigint").alias("id"), quoted(embedding).alias("v"))
    src = src.where(F.col("id").isNotNull() & _taking_part(F.col("v")))
    # -0.0 and 0.0 are one value
    src = src.select("id", F.transform("v", lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    src = src.select("id", "v", F.struct(F.xxhash64("v").alias("a"), F.xxhash64(F.lit(7), "v").alias("b")).alias("k"))
    rows = materialize(src.select("k", "id").distinct(), "vector-ids")
    w = Window.partitionBy("k").orderBy("id")
    least = (rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
             .groupBy("k").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    n = rows.groupBy("k").agg(F.count("*").alias("n"))
    whole = src.groupBy("k").agg(F.first("v").alias("v"))
    classes = whole.join(least, "k").join(n, "k").select("k", F.size("v").alias("dim"), "v", "ids", "n")
    return rows, materialize(classes, "vector-classes")


def pivots_of(classes: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """Up to n pivots for each vector length."""
    w = Window.partitionBy("dim").orderBy("k")
    some = classes.select("dim", "k", "v").withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
    out: dict[int, list] = {}
    for r in some.orderBy("dim", "r").collect():
        out.setdefault(r["dim"], []).append(r["v"])
    return {d: np.array(x, dtype=np.float64) for d, x in out.items()}


def orders(v: np.ndarray, pivots: np.ndarray, keep: int) -> np.ndarray:
    """The numbers of the ``keep`` nearest pivots of each vector, nearest first."""
    apart = (pivots ** 2).sum(axis=1) - 2.0 * (v @ pivots.T)
    return np.argsort(apart, axis=1, kind="stable")[:, :keep].astype(np.uint16)


def inverted(order: np.ndarray, n_pivots: int):
    """Inverted file of some vectors' pivot orders: (start of each pivot's list,
    local numbers, places), lists in pivot order."""
    n, keep = order.shape
    flat = order.ravel()
    by = np.argsort(flat, kind="stable")
    start = np.zeros(n_pivots + 1, dtype=np.int64)
    np.cumsum(np.bincount(flat, minlength=n_pivots), out=start[1:])
    return start, (by // keep).astype(np.uint16), (by % keep).astype(np.uint8)


def footrule_savings(query: np.ndarray, start, members, places, n: int, keep: int) -> np.ndarray:
    """For each of n vectors, half of what shared pivots save of the footrule
    distance to the query's order: Σ keep - max(place in query, place in vector)."""
    saved = np.zeros(n, dtype=np.int32)
    for at, p in enumerate(query.tolist()):
        lo, hi = start[p], start[p + 1]
        saved[members[lo:hi]] += keep - np.maximum(places[lo:hi].astype(np.int32), at)
    return saved


def _double(v: pa.Array, dim: int) -> np.ndarray:
    return v.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def build_index(classes: DataFrame, pivots: dict[int, np.ndarray], keep: int = KEEP, block: int = BLOCK) -> DataFrame:
    """One row per block: dim, n, ids (lists), vectors, start, members, places."""
    blocks = classes.count() // block + 1
    keyed = classes.select("dim", F.pmod(F.col("k.a"), F.lit(blocks)).alias("block"), "ids", "v")

    def one(unit: pa.Table) -> pa.Table:
        dim = unit.column("dim")[0].as_py()
        ids, v = unit.column("ids").combine_chunks(), _double(unit.column("v").combine_chunks(), dim)
        by = np.argsort(np.array([x[0].as_py() for x in ids]), kind="stable")       # ties: smaller ids first
        ids, v = ids.take(pa.array(by)), v[by]
        out = []
        for lo in range(0, len(v), _ROWS):
            part = v[lo:lo + _ROWS]
            start, members, places = inverted(orders(part, pivots[dim], keep), len(pivots[dim]))
            small = part.astype("<f4")
            whole = small if np.array_equal(small, part) else part.astype("<f8")
            out.append({"dim": dim, "n": len(part), "ids": ids[lo:lo + _ROWS].to_pylist(), "vectors": whole.tobytes(),
                        "start": start.astype("<i8").tobytes(), "members": members.astype("<u2").tobytes(),
                        "places": places.tobytes()})
        return pa.Table.from_pylist(out, schema=arrow)

    arrow = pa.schema([("dim", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.list_(pa.int64()))),
                       *[(c, pa.binary()) for c in ("vectors", "start", "members", "places")]])
    return materialize(keyed.groupBy("dim", "block").applyInArrow(
        one, "dim int, n int, ids array<array<bigint>>, vectors binary, start binary, members binary, places binary"),
        "permutation-index")


def packed_queries(queries: DataFrame, pivots: dict[int, np.ndarray], keep: int = KEEP, chunk: int = CHUNK):
    """(packed, chunks): one row per chunk of query classes (k, dim, v): dim, c, keys,
    vectors and pivot orders."""
    chunks = queries.count() // chunk + 1

    def one(unit: pa.Table) -> pa.Table:
        dim = unit.column("dim")[0].as_py()
        v = _double(unit.column("v").combine_chunks(), dim)
        keys = np.stack([unit.column(c).to_numpy() for c in ("a", "b")], axis=1)
        return pa.table({"dim": pa.array([dim], pa.int32()), "c": pa.array([unit.column("c")[0].as_py()], pa.int64()),
                         "keys": [keys.astype("<i8").tobytes()], "queries": [v.astype("<f8").tobytes()],
                         "orders": [orders(v, pivots[dim], keep).astype("<u2").tobytes()]})

    keyed = queries.select("dim", F.pmod(F.col("k.b"), F.lit(chunks)).alias("c"), "k.a", "k.b", "v")
    packed = keyed.groupBy("dim", "c").applyInArrow(one, "dim int, c long, keys binary, queries binary, orders binary")
    return materialize(packed, "query-chunks"), chunks


def _search(pairs: DataFrame, share: float, at_least: int, most: int) -> DataFrame:
    """(a, b, ids, d): for each query of a block's row the ``most`` nearest classes
    among the block's candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                r = {c: b.column(c)[i] for c in b.schema.names}
                n, dim = r["n"].as_py(), r["dim"].as_py()
                raw = r["vectors"].as_py()
                v = np.frombuffer(raw, dtype="<f4" if len(raw) == 4 * n * dim else "<f8").reshape(n, dim)
                start = np.frombuffer(r["start"].as_py(), dtype="<i8")
                members = np.frombuffer(r["members"].as_py(), dtype="<u2")
                places = np.frombuffer(r["places"].as_py(), dtype="u1")
                keys = np.frombuffer(r["keys"].as_py(), dtype="<i8").reshape(-1, 2)
                queries = np.frombuffer(r["queries"].as_py(), dtype="<f8").reshape(-1, dim)
                order = np.frombuffer(r["orders"].as_py(), dtype="<u2").reshape(len(keys), -1)
                m = min(n, max(at_least, int(np.ceil(share * n))))
                back = np.arange(n - 1, -1, -1)
                who, dist, key = [], [], []
                for q in range(len(keys)):
                    saved = footrule_savings(order[q], start, members, places, n, order.shape[1])
                    some = np.arange(n)
                    if m < n:                          # equal footrules: smaller ids first
                        some = np.sort(np.argpartition(saved.astype(np.int64) * n + back, n - m)[n - m:])
                    d = np.sqrt(((v[some].astype(np.float64) - queries[q]) ** 2).sum(axis=1))
                    near = np.argsort(d, kind="stable")[:most]
                    who.append(some[near])
                    dist.append(d[near])
                    key += [q] * len(near)
                if not key:
                    continue
                ids = r["ids"].values.take(pa.array(np.concatenate(who)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[key, 0]), pa.array(keys[key, 1]), ids, pa.array(np.concatenate(dist))],
                    names=["a", "b", "ids", "d"])

    return pairs.mapInArrow(run, "a long, b long, ids array<bigint>, d double")


def nearest(vectors: DataFrame, is_query: Column, n: int = NEAREST, vec_id: str = "vec_id",
            embedding: str = "embedding", pivots: int = PIVOTS, keep: int = KEEP, share: float = SHARE,
            at_least: int = AT_LEAST, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id (column ``id`` in
    ``is_query``) is a query its n nearest found, score the Euclidean distance."""
    spark = vectors.sparkSession
    most = n + 1                                       # one of them may be the query itself
    rows, classes = vector_classes(vectors, vec_id, embedding, most)
    asked = materialize(rows.where(is_query), "query-rows")
    at = pivots_of(classes, pivots)
    index = build_index(classes, at, keep, block)
    wanted = classes.join(asked.select("k").distinct(), "k", "left_semi").select("k", "dim", "v")
    packed, chunks = packed_queries(wanted, at, keep, chunk)
    path = scratch_path(spark, "nearest-classes")
    track_materialized(spark, path)
    for c in range(chunks):
        pairs = index.join(F.broadcast(packed.where(F.col("c") == c).drop("c")), "dim")
        _search(pairs, share, at_least, most).write.mode("append").parquet(path)
    found = spark.read.parquet(path)
    w = Window.partitionBy("a", "b").orderBy("d", F.col("ids")[0])
    best = found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= most)
    each = best.select("a", "b", "d", F.explode("ids").alias("vec_id"))
    lists = each.groupBy("a", "b").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "vec_id"))), 1, most)
                                       .alias("near"))
    lists = materialize(lists.select(F.struct("a", "b").alias("k"), "near"), "nearest-lists")
    sizes = asked.groupBy("k").agg(F.count("*").alias("n"))
    lists = materialize(lists.join(sizes, "k"), "nearest-lists")
    got = join_groups(asked, lists, ["k"], "n", asked.count())
    others = F.filter("near", lambda x: (x["vec_id"] != F.col("id")) | (x["d"] > 0))
    return got.select(F.col("id").alias("query_id"), F.posexplode(F.slice(others, 1, n)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", F.col("x.d").alias("score"))
