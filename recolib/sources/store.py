"""Result store (S3-S8, S16): Parquet datasets under one root, one folder per
catalogue name. Everything is a plain DataFrame read or write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolib import config as C


def dataset_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def save_result(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """Replace one result dataset (S3 for the base tables)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    path = dataset_path(root, name)
    w.parquet(path)
    return path


def store_base_tables(products: DataFrame, ratings: DataFrame, root: str) -> None:
    """S3: store products and ratings, dropping what was there."""
    save_result(products.select(*[f.name for f in C.PRODUCT_SCHEMA]), root, C.PRODUCT)
    save_result(ratings.select(*[f.name for f in C.RATING_SCHEMA]), root, C.RATING)


def load_ratings(spark: SparkSession, root: str) -> DataFrame:
    """Ratings with the typed schema (no inference)."""
    return spark.read.schema(C.RATING_SCHEMA).parquet(dataset_path(root, C.RATING))


def load_products(spark: SparkSession, root: str) -> DataFrame:
    """Products with the typed schema."""
    return spark.read.schema(C.PRODUCT_SCHEMA).parquet(dataset_path(root, C.PRODUCT))


def load_similarity(spark: SparkSession, root: str, name: str = C.PRODUCT_RECS) -> DataFrame:
    """Item lists as flat lookup rows (productId, simProductId, score);
    join against it (the planner broadcasts it only when its size allows)."""
    lists = spark.read.schema(C.ITEM_RECS_SCHEMA).parquet(dataset_path(root, name))
    return lists.select("productId", F.inline("recs").alias("simProductId", "score"))


def similarity_map(flat: DataFrame) -> DataFrame:
    """S7 map view: (productId, sims: map<simProductId, score>)."""
    return flat.groupBy("productId").agg(
        F.map_from_entries(F.collect_list(F.struct("simProductId", "score"))).alias("sims"))


def upsert_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """S8 in batch form: rows of ``new`` replace all rows of ``old`` with the same
    key (remove then insert); other rows of ``old`` stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Temp views for SQL access."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
