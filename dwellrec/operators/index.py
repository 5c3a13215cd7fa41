"""Visitor index and item catalogue.

Visitors are strings; ALS needs INT ids. Ids are dense, 0-based and follow
the visitor's sort order, so they are reproducible and the index saved with a
model maps every id back to its visitor (never rebuilt on reload).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwellrec.operators.ranking import dense_ids
from dwellrec.session import materialize


def build_user_index(interactions: DataFrame, key: str = "visitor_trace") -> DataFrame:
    """DataFrame[visitor_trace STRING, user INT, n_rows BIGINT].

    ``n_rows`` (interactions per visitor) comes from the same aggregation as
    the distinct keys and lets ``attach_user_ids`` find hot visitors.
    Ids above 2**31-1 raise (ANSI cast) instead of wrapping.
    """
    ix = dense_ids(interactions, key, id_col="_id",
                   aggs=[F.count(F.lit(1)).alias("n_rows")])
    return ix.select(F.col(key).alias("visitor_trace"),
                     F.col("_id").cast("int").alias("user"), "n_rows")


def extend_user_index(index: DataFrame, interactions: DataFrame,
                      key: str = "visitor_trace") -> DataFrame:
    """``index`` (visitor_trace, user, n_rows) grown by the visitors of new
    interactions: known visitors keep their ids (a model trained with them stays
    valid) and add their new rows; new ones get the next ids in sort order.

    Interactions are counted per visitor first (partial aggregates), so a hot
    visitor is one row in the joins, and only the new keys are sorted."""
    seen = interactions.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("visitor_trace")).agg(
        F.count(F.lit(1)).alias("_more"))
    seen = materialize(seen, "visitor-counts")
    known = index.join(seen, "visitor_trace", "left").select(
        "visitor_trace", "user", (F.col("n_rows") + F.coalesce("_more", F.lit(0))).alias("n_rows"))
    start = index.agg(F.max("user")).first()[0]
    fresh = dense_ids(seen.join(index.select("visitor_trace"), "visitor_trace", "left_anti"), "visitor_trace",
                      "_id", [F.max("_more").alias("n_rows")])
    first = 0 if start is None else int(start) + 1
    return known.unionByName(fresh.select("visitor_trace", (F.col("_id") + F.lit(first)).cast("int").alias("user"),
                                          "n_rows"))


def hot_threshold(total_rows: int, partitions: int) -> int:
    """A key holding more rows than an average shuffle partition is hot.
    Fewer than ``partitions`` keys can exceed it, which bounds the hot set."""
    return max(1, total_rows // max(1, partitions))


def attach_user_ids(interactions: DataFrame, user_index: DataFrame,
                    partitions: int | None = None) -> DataFrame:
    """interactions ⋈ user_index on visitor → (user INT, item INT, rating DOUBLE).

    Hot visitors (more rows than one shuffle partition should hold) are split
    off: their rows join a broadcast of the hot index entries (fewer than
    ``partitions`` rows by construction) with no shuffle, and are removed from
    the shuffled join by a broadcast anti join, so no reducer receives a hot
    visitor's rows.
    """
    spark = interactions.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = user_index.agg(F.sum("n_rows")).first()[0]
    limit = hot_threshold(int(total or 0), partitions)
    ix = user_index.select("visitor_trace", "user", "n_rows")
    cols = [F.col("user"), F.col("poi").alias("item"), F.col("rating")]
    hot = ix.where(F.col("n_rows") > limit).select("visitor_trace", "user")
    hot_b = F.broadcast(hot)
    hot_rows = interactions.join(hot_b, "visitor_trace").select(*cols)
    cold_rows = (interactions.join(hot_b, "visitor_trace", "left_anti")
                 .join(ix.where(F.col("n_rows") <= limit).select("visitor_trace", "user"),
                       "visitor_trace")
                 .select(*cols))
    return hot_rows.unionByName(cold_rows)


def item_catalogue(ratings: DataFrame, item: str = "item") -> DataFrame:
    """DataFrame[item INT, item_ix BIGINT]: distinct items with a dense 0-based
    position (the catalogue negatives are drawn from)."""
    cat = dense_ids(ratings.select(item), item, id_col="item_ix")
    return cat.select(F.col(item).alias("item"), "item_ix")


def attach_visitors(df: DataFrame, user_index: DataFrame) -> DataFrame:
    """Inverse index: add visitor_trace to rows keyed by ``user`` (1:1 join)."""
    return df.join(user_index.select("user", "visitor_trace"), "user")
