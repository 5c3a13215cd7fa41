"""Connected components of a distributed edge table.

Alternating large-star and small-star rounds: each vertex is re-attached to
the least vertex it sees until every component is a star. Least neighbours are
found by a pre-aggregated minimum and joined back, each half-round is written
to the shared folder, and only an edge count and a checksum reach the driver.
A star's centre may hold any share of the edges: the join's two sides are plain
scans, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) → (u, v, m): m is the least of u and its partners."""
    low = materialize(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
    return pairs.join(low, "u")


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _least(down)
    return (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(near.select("u", F.col("m").alias("v"))))


def _settle(e: DataFrame, name: str) -> DataFrame:
    return materialize(e.where("u <> v").distinct(), name)


def _mark(e: DataFrame):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (u, v BIGINT) → (vertex, root): root is the least vertex of the
    component. Vertices without an edge to another vertex are absent."""
    e = _settle(edges.select("u", "v"), "edges")
    mark = _mark(e)
    while mark[0]:
        e = _settle(_small_star(_settle(_large_star(e), "large-star")), "small-star")
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return (e.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
            .unionByName(e.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()))
