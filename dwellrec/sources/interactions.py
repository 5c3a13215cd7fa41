"""Interaction sources.

The engine's input is a table ``(visitor_trace STRING, poi INT, rating DOUBLE)``
read by column *name* (not position) and cast once. ``from_tables`` builds it
from the TPC-H-style test tables: a customer's name is the visitor, a line's
part key the item, and a numeric line column (price by default) the strength.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERACTION_SCHEMA = T.StructType([
    T.StructField("visitor_trace", T.StringType(), True),
    T.StructField("poi", T.IntegerType(), True),
    T.StructField("rating", T.DoubleType(), True),
])

RATING_SCHEMA = "user INT, item INT, rating DOUBLE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def from_tables(spark: SparkSession, sf_dir: str,
                rating_col: str = "l_extendedprice") -> DataFrame:
    """customer ⋈ orders ⋈ lineitem → (visitor_trace, poi, rating).

    Only the five needed columns are read (Parquet column pruning). Both joins
    are equi-joins that AQE plans at run time (broadcast when a side is small,
    sort-merge otherwise, skewed partitions split). Orders meet their customers
    first, so the lines, the largest side, are shuffled once.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", rating_col)
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    named = od.join(cu, od.o_custkey == cu.c_custkey).select("o_orderkey", "c_name")
    joined = li.join(named, li.l_orderkey == named.o_orderkey)
    return typed(joined.select(
        F.col("c_name").alias("visitor_trace"),
        F.col("l_partkey").alias("poi"),
        F.col(rating_col).alias("rating")))


def typed(df: DataFrame, visitor: str = "visitor_trace", item: str = "poi",
          rating: str = "rating") -> DataFrame:
    """Select the three columns by name and cast them (ANSI: malformed or
    overflowing values raise instead of becoming NULL)."""
    return df.select(
        F.col(visitor).cast("string").alias("visitor_trace"),
        F.col(item).cast("int").alias("poi"),
        F.col(rating).cast("double").alias("rating"))


def read_table(spark: SparkSession, name_or_path: str, fmt: str | None = None,
               options: dict | None = None, **columns) -> DataFrame:
    """A catalog table (``spark.table``) or a file path (``spark.read`` with
    reader ``options``); ``columns`` names the visitor/item/rating columns."""
    if fmt is None and "/" not in name_or_path:
        df = spark.table(name_or_path)
    else:
        df = spark.read.format(fmt or "parquet").options(**(options or {})).load(name_or_path)
    return typed(df, **columns)


def valid_row() -> Column:
    return (F.col("visitor_trace").isNotNull() & F.col("poi").isNotNull()
            & F.col("rating").isNotNull() & ~F.isnan(F.col("rating")))


def clean(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL visitor, item or rating, or a NaN rating."""
    return df.where(valid_row())


def dropped_counts(df: DataFrame) -> DataFrame:
    """One row: how many rows ``clean`` drops, and why."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("visitor_trace").isNull()).alias("null_visitor"),
        F.count_if(F.col("poi").isNull()).alias("null_item"),
        F.count_if(F.col("rating").isNull() | F.isnan(F.col("rating"))).alias("null_rating"),
        F.count_if(~valid_row()).alias("dropped"))


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``user<TAB>item<TAB>rating`` lines, no header."""
    return spark.read.csv(path, sep="\t", schema=RATING_SCHEMA, header=False, mode="FAILFAST")


def shift_ratings(df: DataFrame, offset: float, col: str = "rating") -> DataFrame:
    """rating - offset (the legacy file path shifted dwell-time ratings)."""
    return df.withColumn(col, F.col(col) - F.lit(float(offset)))


def input_fingerprint(interactions: DataFrame) -> DataFrame:
    """One row (rows, sum1, sum2): the row count and the sums of two independent
    60-bit hashes of the rows. It depends on the multiset of rows alone, not on
    their order or partitions, so two reads of a source can be compared (a saved
    model records the one it was trained on). Strengths count to nine decimals;
    rows alike count each."""
    parts = [F.col("visitor_trace"), F.col("poi").cast("string"),
             F.col("rating").cast("decimal(28,9)").cast("string")]
    text = F.concat_ws("|", *[F.coalesce(p, F.lit("\\N")) for p in parts])
    digest = F.md5(text.cast("binary"))
    sums = [F.coalesce(F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)")),
                       F.lit(0)).cast("decimal(38,0)").cast("string").alias(name)
            for at, name in ((1, "sum1"), (17, "sum2"))]
    return interactions.agg(F.count(F.lit(1)).alias("rows"), *sums)
