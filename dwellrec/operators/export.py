"""Recommendation lines: ``visitor \\u0001 (item,score);(item,score);...`` in
descending score order. Pure column expressions over arrays of at most N
elements per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrec.functions.exprs import LINE_SEPARATOR


def _pair_text(item: Column, score: Column) -> Column:
    return F.concat(F.lit("("), item.cast("string"), F.lit(","), score.cast("string"), F.lit(")"))


def format_line(visitor: Column, entries: Column, item_field: str, score_field: str) -> Column:
    body = F.array_join(
        F.transform(entries, lambda r: _pair_text(r[item_field], r[score_field])), ";")
    return F.concat(visitor, F.lit(LINE_SEPARATOR), body)


def lines_from_lists(recs: DataFrame, user_index: DataFrame,
                     list_col: str = "recommendations") -> DataFrame:
    """Model output lists (already in descending order) → (user, visitor_trace, value).
    Library scores are printed as DOUBLE text."""
    joined = recs.join(user_index.select("user", "visitor_trace"), "user")
    entries = F.transform(F.col(list_col), lambda r: F.struct(
        r["item"].alias("item"), r["rating"].cast("double").alias("score")))
    return joined.select("user", "visitor_trace",
                         format_line(F.col("visitor_trace"), entries, "item", "score").alias("value"))


def lines_from_ranked(ranked: DataFrame, user_index: DataFrame,
                      score_col: str = "score") -> DataFrame:
    """Flat top-N rows (user, rank, item, score) → one line per user.

    The per-user group is at most N rows (the rows are already cut to N), so
    the collected array is bounded; ``array_sort`` puts it in rank order.
    """
    lists = ranked.groupBy("user").agg(F.array_sort(F.collect_list(
        F.struct(F.col("rank"), F.col("item"), F.col(score_col).alias("score")))).alias("entries"))
    joined = lists.join(user_index.select("user", "visitor_trace"), "user")
    return joined.select("user", "visitor_trace",
                         format_line(F.col("visitor_trace"), F.col("entries"), "item", "score")
                         .alias("value"))


def sort_lists_ascending(recs: DataFrame, list_col: str = "recommendations") -> DataFrame:
    """Re-sort each list by ascending rating (ties by item)."""
    return recs.withColumn(list_col, F.array_sort(
        F.col(list_col),
        lambda a, b: F.when(a["rating"] < b["rating"], -1)
        .when(a["rating"] > b["rating"], 1)
        .when(a["item"] < b["item"], -1)
        .when(a["item"] > b["item"], 1).otherwise(0)))
