"""Exact dedup: tree-merge of sorted digest runs (DataFrame functions only).

Every row becomes (doc_id, SHA-256, byte length, XXH64) and belongs to one of
2^k runs. Rounds follow a binomial tree: in each round the runs whose numbers
agree but for the lowest bits are merged (``fan_in`` ways), and every digest
keeps one identifier and a count. A round is partitioned by (run, digest), so
all tasks stay busy while the number of runs falls to one, and a hot digest is
at most one entry per run from the first round on. Runs are written sorted by
digest to the shared folder between rounds (a lost executor re-reads files).

Verified: digest, byte length and an independent 64-bit hash together are the
merge key at every level, so texts that disagree in any of them never merge.

Defined results
  null text           equals the empty text
  null doc_id         loses against any id; stays only if all ids are null
  repeated rows       rows alike in id and text: exactly one is kept
  empty table         empty result
  other columns       ignored by ``exact_dedup``, carried by ``drop_copies``
  very long texts     hashed whole, JVM side
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.llm.common import as_text, fresh, join_groups, partitions, quoted, row_key
from dwellrec.session import materialize

KEY = ["digest", "n_bytes", "check_hash"]


def digest_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, row_tag, digest, n_bytes, check_hash) of every row, frozen."""
    t = as_text(text)
    return materialize(docs.select(
        quoted(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row_tag"),
        F.unhex(F.sha2(t, 256)).alias("digest"), F.octet_length(t).alias("n_bytes"),
        F.xxhash64(t).alias("check_hash")), "digest-rows")


def _best(keep: str):
    if keep == "largest":
        return F.max, F.struct(F.col("doc_id").isNotNull().alias("p"), "doc_id", "row_tag")
    if keep == "smallest":
        return F.min, F.struct(F.col("doc_id").isNull().alias("p"), "doc_id", "row_tag")
    raise ValueError("keep must be 'largest' or 'smallest'")


def merge_runs(rows: DataFrame, keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """digest rows → one row per digest: KEY, kept struct(p, doc_id, row_tag), n."""
    pick, ident = _best(keep)
    bits = max(1, int(math.log2(fan_in)))
    left = max(1, math.ceil(math.log2(partitions(rows.sparkSession))))
    run = F.pmod(F.xxhash64("row_tag"), F.lit(1 << left))
    level = rows.select(run.alias("run"), *KEY, ident.alias("kept"), F.lit(1).cast("bigint").alias("n"))
    while True:
        level = level.groupBy("run", *KEY).agg(pick("kept").alias("kept"), F.sum("n").alias("n"))
        level = materialize(level.sortWithinPartitions("run", "digest"), "digest-runs")
        if left == 0:
            return level.drop("run")
        step = min(bits, left)
        left -= step
        level = level.withColumn("run", F.shiftright("run", step))


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digest_rows(docs, doc_id, text)
    groups = merge_runs(rows, keep, fan_in)
    out = join_groups(rows, groups, KEY, "n", rows.count())
    return out.select(
        "doc_id", F.col("kept.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row_tag") == F.col("kept.row_tag")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                keep: str = "smallest", fan_in: int = 8) -> DataFrame:
    """``docs`` (all columns) without the copies that ``exact_dedup`` drops.

    Kept rows are found by (doc_id, digest). Where whole rows repeat, one of
    them is chosen by a pre-aggregated minimum over all columns.
    """
    groups = merge_runs(digest_rows(docs, doc_id, text), keep, fan_in)
    did, dig = fresh(docs, "_kept_id"), fresh(docs, "_kept_digest")
    winners = groups.select(F.col("kept.doc_id").alias(did), F.col("digest").alias(dig),
                            F.col("n").alias("_n"))
    t = F.unhex(F.sha2(as_text(text), 256))
    cond = quoted(doc_id).eqNullSafe(F.col(did)) & (t == F.col(dig))
    singles = docs.join(winners.where("_n = 1").select(did, dig), cond, "left_semi")
    several = docs.join(winners.where("_n > 1").select(did, dig), cond, "left_semi")
    return singles.unionByName(one_per_key(several, row_key(doc_id, text)))


def one_per_key(docs: DataFrame, key) -> DataFrame:
    """One row of ``docs`` per value of ``key``: the least over all columns
    (map-side aggregated, so many equal rows are one per task)."""
    k = fresh(docs, "_key")
    cols = docs.columns
    packed = F.struct(*[quoted(c).alias(f"c{i}") for i, c in enumerate(cols)])
    best = docs.groupBy(key.alias(k)).agg(F.min(packed).alias("_row"))
    return best.select(*[F.col(f"_row.c{i}").alias(c) for i, c in enumerate(cols)])
