"""Helpers shared by the corpus operators: row keys, names that cannot clash,
a distributed ordinal, and a join that survives hot keys."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrec.session import materialize


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, prefixed until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def quoted(name: str) -> Column:
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_text(name: str = "text") -> Column:
    """The text column with null as the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A never-null 128-bit identity of (doc_id, text): rows that agree in both
    share it, rows that differ in either do not."""
    d, t = quoted(doc_id), quoted(text)
    return F.struct(F.xxhash64(d, F.lit(0), t, F.lit(1)).alias("a"),
                    F.xxhash64(F.lit(11), t, F.lit(2), d).alias("b"))


def partitions(spark) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ordinal(df: DataFrame, order, name: str = "_ix") -> DataFrame:
    """Rows of ``df`` with a dense 0-based BIGINT position in ``order``.

    A range-partitioned sort; partition and position are written with the rows
    to the shared folder, so they are frozen, and one count per partition
    reaches the driver. No window holds the table.
    """
    cols = df.columns
    sorted_rows = df.orderBy(*order).select(
        *cols, F.spark_partition_id().alias("_op"), F.monotonically_increasing_id().alias("_om"))
    frozen = materialize(sorted_rows, "ordinal")
    counts = {r["_op"]: r["count"] for r in frozen.groupBy("_op").count().collect()}
    starts, total = [], 0
    for p in range(max(counts, default=-1) + 1):
        starts.append(total)
        total += counts.get(p, 0)
    start = F.element_at(F.from_json(F.lit(json.dumps(starts or [0])), "array<bigint>"),
                         F.col("_op") + 1)
    local = F.col("_om") - F.shiftleft(F.col("_op").cast("bigint"), 33)
    return frozen.select(*cols, (start + local).alias(name))


@contextmanager
def wide_rows(spark, per_batch: int = 4):
    """Jobs run inside hand Python ``per_batch`` rows at a time: for tables whose rows
    are packed blocks of some MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, str(per_batch))
    try:
        yield
    finally:
        spark.conf.set(key, was)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str,
                total: int) -> DataFrame:
    """rows ⋈ groups on ``keys`` (inner; ``groups`` has one row per key and its
    row count in ``size``) without a reducer that holds a hot group.

    Groups with more than total/partitions rows are hot: fewer than
    ``partitions`` such groups can exist, which bounds the broadcast. Their
    rows join it in place; the others take the shuffled join.
    """
    limit = max(1, total // partitions(rows.sparkSession))
    hot = F.broadcast(groups.where(F.col(size) > limit))
    cold = groups.where(F.col(size) <= limit)
    return (rows.join(hot, keys)
            .unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys)))
