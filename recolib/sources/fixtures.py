"""Logical tables of the recommender, built from the driver's test tables.

Every table is a lazy DataFrame over the parquet scans, so Catalyst prunes the
columns and pushes filters into the scans of whatever query uses it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolib import config as C
from recolib.functions import columns as X


class Fixtures:
    """Typed recommender tables over ``<sf_dir>/<table>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- ratings: lineitem joined to its order -------------------------------
    @cached_property
    def ratings(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
        od = self.table("orders").select("o_orderkey", "o_custkey")
        return (li.join(od, li.l_orderkey == od.o_orderkey)
                .select(F.col("o_custkey").cast("bigint").alias("userId"),
                        F.col("l_partkey").cast("bigint").alias("productId"),
                        (F.floor((F.col("l_quantity") - 1) / 10) + 1).cast("double").alias("score"),
                        X.epoch_seconds(F.col("l_shipdate")).cast("bigint").alias("timestamp")))

    # -- products: part ------------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.col("p_partkey").cast("bigint").alias("productId"),
            F.col("p_name").alias("name"),
            F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("imageUrl"),
            F.col("p_type").alias("categories"),
            F.concat_ws(C.TAG_SEP, F.replace(F.col("p_name"), F.lit(" "), F.lit(C.TAG_SEP)),
                        F.col("p_brand"), F.col("p_type")).alias("tags"))

    # -- users: customer -----------------------------------------------------
    @cached_property
    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").cast("bigint").alias("userId"),
                                             F.col("c_name").alias("username"))

    # -- rating events: events -------------------------------------------------
    @cached_property
    def events(self) -> DataFrame:
        """All events with the columns the log needs (event type kept)."""
        e = self.table("events")
        return e.select(
            "event_id", "event_type",
            F.col("user_id").cast("bigint").alias("userId"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("productId"),
            (F.least(F.lit(10.0), F.floor(F.col("value") / 10) + 1) / 2).cast("double").alias("score"),
            X.epoch_seconds(F.col("ts")).alias("timestamp"))

    @cached_property
    def rating_events(self) -> DataFrame:
        return self.events.select("event_id", "userId", "productId", "score", "timestamp")

    # -- text renderings of the tables -----------------------------------------
    @cached_property
    def product_lines(self) -> DataFrame:
        """Products as '^'-separated 7-field lines (fields 2 and 3 constant)."""
        p = self.products
        return p.select(F.concat_ws(C.PRODUCT_FIELD_SEP, F.col("productId").cast("string"), "name",
                                    F.lit("0"), F.lit("0"), "imageUrl", "categories", "tags")
                        .alias("value"))

    @cached_property
    def rating_lines(self) -> DataFrame:
        r = self.ratings
        return r.select(F.concat_ws(",", *[F.col(c).cast("string") for c in r.columns]).alias("value"))

    @cached_property
    def log_lines(self) -> DataFrame:
        """Application log: purchase events carry the rating payload; other
        events are plain lines that the filter must drop."""
        e = self.events
        head = F.concat(F.lit("INFO --- [exec-"), (F.col("event_id") % 8).cast("string"),
                        F.lit("] rest.ProductRestApi : "))
        rating = X.format_rating_log("userId", "productId", "score", "timestamp")
        other = F.concat(F.lit("event "), F.col("event_type"), F.lit(" user="),
                         F.col("userId").cast("string"))
        return e.select("event_id",
                        F.concat(head, F.when(F.col("event_type") == "purchase", rating)
                                 .otherwise(other)).alias("value"))

    # -- factor vectors: embeddings ------------------------------------------
    @cached_property
    def user_factors(self) -> DataFrame:
        e = self.table("embeddings")
        return e.where(F.col("vec_id") % 2 == 0).select(
            F.expr("vec_id div 2").alias("id"), F.col("embedding").alias("features"))

    @cached_property
    def item_factors(self) -> DataFrame:
        e = self.table("embeddings")
        return e.where(F.col("vec_id") % 2 == 1).select(
            F.expr("(vec_id - 1) div 2").alias("id"), F.col("embedding").alias("features"))
