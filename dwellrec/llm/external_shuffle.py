"""Sharding by a two-pass external shuffle.

Pass 1 scatters whole records into memory-sized buckets by a seeded hash of
their content (uniform, whatever the sources or lengths). Pass 2 orders each
bucket by that hash, applies a seeded Fisher-Yates shuffle to it in memory,
and writes it to the shared folder. The buckets one after the other are one
random permutation of the table; shards are equal consecutive pieces of it.

Law ``rows``: with N rows and S shards, position p lies in shard ⌊p·S/N⌋, so
counts differ by at most one; slots are gapless from 0.

The same rows and seed give the same permutation on any cluster. Bucket
offsets are a table (16 bytes a bucket, a millionth of the input): totals of
blocks of buckets and running counts inside them, joined to the rows by bucket.
Spark broadcasts it while it is below the session's threshold and sorts beyond.
The driver receives the number of rows and of bytes. Bucket sizes count whole
rows, text and other columns.

Defined results: null ids or texts are hashed as nulls (size 1 for a null
text); copies with different ids spread over the buckets; rows alike in id and
text share one, or if they would overfill it, consecutive ones in turn (they
are interchangeable); an empty table gives an empty result; all columns are
carried, and the added ones are prefixed with ``_`` where the table already has
the name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellrec.llm.common import fresh, quoted
from dwellrec.session import materialize

SHUFFLE_SEED = 20240229
BUCKET_BYTES = 16 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A permutation of 0..n-1 by the classic backward swaps."""
    rng = np.random.Generator(np.random.Philox(key=[seed, bucket]))
    order = list(range(n))
    draws = rng.integers(0, np.arange(n, 0, -1)) if n else []
    for i, j in zip(range(n - 1, -1, -1), np.asarray(draws).tolist()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def row_bytes(docs: DataFrame):
    """Size of a whole row: bytes of texts and binaries, of other nested values
    their JSON's, 8 of each other value, and 64 for the row itself."""
    size = F.lit(64)
    for f in docs.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            size = size + F.lit(8)
    return size.cast("bigint")


def bucket_offsets(counts: DataFrame, bucket: str, block: int = 4096) -> DataFrame:
    """(bucket, _start): rows in all buckets before, from (bucket, count). Blocks of
    buckets are summed first and their running totals taken by a join of each
    block with those of lower number in its own and lower blocks of blocks, so
    no window holds all buckets."""
    b = F.col(bucket)
    first = counts.select(bucket, "count", F.expr(f"`{bucket}` div {block}").alias("_k1"),
                          F.expr(f"`{bucket}` div {block * block}").alias("_k2"))
    inner = first.withColumn("_in", F.sum("count").over(
        Window.partitionBy("_k1").orderBy(b).rowsBetween(Window.unboundedPreceding, -1)))
    blocks = first.groupBy("_k2", "_k1").agg(F.sum("count").alias("_n")).withColumn("_mid", F.sum("_n").over(
        Window.partitionBy("_k2").orderBy("_k1").rowsBetween(Window.unboundedPreceding, -1)))
    tops = blocks.groupBy("_k2").agg(F.sum("_n").alias("_n"))
    # one row for each 2^24 buckets (256 TB): a handful, so all its prefixes are as few
    before = tops.groupBy().agg(F.sort_array(F.collect_list(F.struct("_k2", "_n"))).alias("_all")).select(
        F.explode(F.expr("transform(_all, (x, i) -> struct(x._k2 as k, "
                         "aggregate(slice(_all, 1, i), 0L, (a, y) -> a + y._n) as n))")).alias("t"))
    before = before.select(F.col("t.k").alias("_k2"), F.col("t.n").alias("_high"))
    zero = F.lit(0)
    return (inner.join(blocks.select("_k2", "_k1", "_mid").join(before, "_k2").drop("_k2"), "_k1")
            .select(bucket, (F.col("_high") + F.coalesce("_mid", zero) + F.coalesce("_in", zero)).alias("_start")))


def shuffled_buckets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     seed: int = SHUFFLE_SEED, bucket_bytes: int = BUCKET_BYTES):
    """(written table of all columns + bucket + position in bucket, names of
    the two added columns)."""
    b, h, s, n, many_of = (fresh(docs, c) for c in ("_bucket", "_hash", "_pos", "_number", "_spread"))
    size = row_bytes(docs)
    hashed = docs.withColumn(h, F.xxhash64(F.lit(seed), quoted(doc_id), F.lit(1), quoted(text)))
    hashed = hashed.withColumn(n, F.monotonically_increasing_id())    # used by rows alike only
    alike = materialize(hashed.groupBy(h).agg(
        F.sum(size).alias("_bytes")), "row-hashes")
    total = alike.agg(F.sum("_bytes")).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_bytes))
    # rows alike that would overfill a bucket (fewer than n_buckets hashes)
    many = materialize(alike.where(F.col("_bytes") > bucket_bytes).select(
        h, F.ceil(F.col("_bytes") / F.lit(bucket_bytes)).alias(many_of)), "hot-row-hashes")
    salt = F.pmod(F.col(n), F.coalesce(many_of, F.lit(1)))
    hashed = hashed.join(many, h, "left").withColumn(
        b, F.pmod(F.pmod(F.col(h), F.lit(n_buckets)) + salt, F.lit(n_buckets))).select(*[quoted(c) for c in docs.columns], h, b)
    schema = T.StructType([*hashed.schema.fields, T.StructField(s, T.LongType())])
    names = hashed.columns
    id_at = names.index(doc_id)

    def shuffle_bucket(group: pa.Table) -> pa.Table:
        keys = [(h, "ascending")]
        if pa.types.is_integer(group.schema.field(id_at).type):
            keys.append((names[id_at], "ascending"))
        group = group.sort_by(keys)
        order = fisher_yates(len(group), seed, int(group.column(b)[0].as_py()))
        out = group.take(pa.array(order))
        return out.append_column(s, pa.array(np.arange(len(out)), pa.int64()))

    spread = hashed.groupBy(b).applyInArrow(shuffle_bucket, schema)
    return materialize(spread.drop(h), "shuffled-buckets"), b, s


def shard(docs: DataFrame, n_shards: int = 16, doc_id: str = "doc_id", text: str = "text",
          seed: int = SHUFFLE_SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` + shard INT + slot BIGINT, under law ``rows``."""
    written, b, s = shuffled_buckets(docs, doc_id, text, seed, bucket_bytes)
    counts = materialize(written.groupBy(b).count(), "bucket-counts")
    n = counts.agg(F.sum("count")).first()[0] or 0
    starts = materialize(bucket_offsets(counts, b), "bucket-offsets")
    st = fresh(written, "_start")
    written = written.join(starts.withColumnRenamed("_start", st), b)
    p, sh, sl = (fresh(written, c) for c in ("_at", "shard", "slot"))
    placed = written.withColumn(p, F.col(st) + F.col(s))
    placed = placed.withColumn(sh, F.expr(f"cast(`{p}` * {int(n_shards)} div {max(1, n)} as int)"))
    # the first position of a shard is the least p with p·S/N >= shard
    first = F.expr(
        f"(cast(`{sh}` as bigint) * {max(1, n)} + {int(n_shards) - 1}) div {int(n_shards)}")
    return placed.withColumn(sl, F.col(p) - first).drop(b, s, p, st)


def write_shards(sharded: DataFrame, path: str, shard_col: str = "shard",
                 slot_col: str = "slot") -> None:
    """Write one folder per shard, rows in slot order within each file."""
    (sharded.repartitionByRange(shard_col, slot_col).sortWithinPartitions(shard_col, slot_col)
     .write.partitionBy(shard_col).parquet(path))
