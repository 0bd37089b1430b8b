"""Serving queries (V1-V9) as set-oriented DataFrame functions.

Each takes its keys as a DataFrame, so one plan answers any number of lookups
(the bulk form of a point read); a single lookup is a one-row key frame or a
literal ``isin``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from recolib.operators import statistics as S

PRODUCT_COLS = ["productId", "name", "imageUrl", "categories", "tags"]


def product_enriched(products: DataFrame, averages: DataFrame) -> DataFrame:
    """J8 + P21: product rows with their mean score, 0.0 when unrated."""
    avg = averages.select("productId", F.col("avg"))
    return (products.select(*PRODUCT_COLS).join(avg, "productId", "left")
            .select(*PRODUCT_COLS, F.coalesce(F.col("avg"), F.lit(0.0)).alias("score")))


def products_for_ids(products: DataFrame, averages: DataFrame, ids: DataFrame | Iterable[int]) -> DataFrame:
    """Products whose id is in ``ids`` (a DataFrame with productId, or
    literals). Order, scores and duplicates of the id list are not kept."""
    base = products.select(*PRODUCT_COLS)
    if isinstance(ids, DataFrame):
        base = base.join(ids.select("productId"), "productId", "left_semi")
    else:
        base = base.where(F.col("productId").isin([int(i) for i in ids]))
    return product_enriched(base, averages)


def product_info(products: DataFrame, averages: DataFrame, ids) -> DataFrame:
    """V5/P10: product info for each looked-up id (unknown ids give no row)."""
    return products_for_ids(products, averages, ids)


def search_products(products: DataFrame, averages: DataFrame, pattern: str) -> DataFrame:
    """Names matching a regular expression anywhere, case sensitive."""
    return product_enriched(products.where(F.col("name").rlike(pattern)), averages)


def hot_products(recent_counts: DataFrame, products: DataFrame, averages: DataFrame, n: int) -> DataFrame:
    """V1: the products of the first n hot-list rows (at most n rows)."""
    return products_for_ids(products, averages, S.hot_list(recent_counts, n))


def most_rated_products(counts: DataFrame, products: DataFrame, averages: DataFrame, n: int) -> DataFrame:
    """V2: the products of the n most rated."""
    return products_for_ids(products, averages, S.most_rated_list(counts, n))


def similar_products(item_recs_flat: DataFrame, products: DataFrame, averages: DataFrame,
                     query_ids: DataFrame, ordered: bool = False) -> DataFrame:
    """V3/V4: for each queried product, the products of its similar-items list.

    ``item_recs_flat`` is (productId, [rank,] simProductId, score); output is
    (queryId, <product columns>, score) with the list's order and duplicates
    dropped, as the reference returns it. ``ordered=True`` keeps the list's
    rank and similarity as ``rank`` and ``sim`` instead.
    """
    q = query_ids.select(F.col("productId").alias("queryId")).distinct()
    if ordered:
        cols = [F.col("productId").alias("queryId"), F.col("simProductId").alias("productId"),
                F.col("score").alias("sim")] + ([F.col("rank")] if "rank" in item_recs_flat.columns else [])
        recs = item_recs_flat.select(*cols).join(q, "queryId", "left_semi")
        return recs.join(product_enriched(products, averages), "productId")
    pairs = (item_recs_flat.select(F.col("productId").alias("queryId"), F.col("simProductId").alias("productId"))
             .join(q, "queryId", "left_semi").distinct())
    enriched = product_enriched(products, averages)
    return pairs.join(enriched, "productId").select("queryId", *PRODUCT_COLS, "score")


def user_list_products(user_recs_flat: DataFrame, users: DataFrame, products: DataFrame,
                       averages: DataFrame, usernames: DataFrame, n: int | None = None) -> DataFrame:
    """V8/V9 (J9): username -> user id -> that user's list -> product rows.

    ``user_recs_flat`` is (userId, rank, productId, score). The reference ignores
    ``num``; ``n=None`` keeps the whole list, else ranks 1..n.
    """
    ids = users.join(usernames.select("username"), "username", "left_semi").select("userId", "username")
    recs = user_recs_flat if n is None else user_recs_flat.where(F.col("rank") <= n)
    picked = recs.select("userId", "productId").join(ids, "userId").select("username", "productId").distinct()
    return picked.join(product_enriched(products, averages), "productId").select("username", *PRODUCT_COLS, "score")
