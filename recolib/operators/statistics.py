"""Popularity statistics (A1-A3) and their top-n lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolib.functions import columns as X


def rate_more_products(ratings: DataFrame) -> DataFrame:
    """A1: number of ratings per product -> (productId, count)."""
    return ratings.groupBy("productId").agg(F.count("productId").alias("count"))


def rate_more_recently_products(ratings: DataFrame, ordered: bool = False) -> DataFrame:
    """A2: ratings per (month, product) -> (productId, count, yearmonth).

    ``ordered`` adds the reference's write order (yearmonth desc, count desc); it
    costs a range shuffle, so leave it off unless the order is consumed.
    """
    out = (ratings.select("productId", X.year_month("timestamp").alias("yearmonth"))
           .groupBy("yearmonth", "productId").agg(F.count("productId").alias("count"))
           .select("productId", "count", "yearmonth"))
    if ordered:
        out = out.orderBy(F.col("yearmonth").desc(), F.col("count").desc(), "productId")
    return out


def rank_in_month(recent_counts: DataFrame) -> DataFrame:
    """T1 as a column: each month's products by count desc, ties by id -> adds ``rank``.

    The write order of the table (month desc, count desc) is (yearmonth desc, rank)."""
    w = Window.partitionBy("yearmonth").orderBy(F.col("count").desc(), F.col("productId"))
    return recent_counts.withColumn("rank", F.row_number().over(w))


def average_products(ratings: DataFrame) -> DataFrame:
    """A3: mean score per product -> (productId, avg)."""
    return ratings.groupBy("productId").agg(F.avg("score").alias("avg"))


def hot_list(recent_counts: DataFrame, n: int) -> DataFrame:
    """Newest months first, then most rated, then id; first n rows.

    An item can appear once per month, so the list can repeat an id. Spark plans
    this as a TakeOrderedAndProject: each task keeps its own n best rows.
    """
    return recent_counts.orderBy(F.col("yearmonth").desc(), F.col("count").desc(),
                                 F.col("productId")).limit(n)


def most_rated_list(counts: DataFrame, n: int) -> DataFrame:
    """Most rated first, ties by id; first n rows."""
    return counts.orderBy(F.col("count").desc(), F.col("productId")).limit(n)
