"""Text sources: product lines, rating CSV lines, application log lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolib.functions import columns as X


def parse_product_lines(lines: DataFrame, col: str = "value", keep_bad: bool = False) -> DataFrame:
    """Split on '^', keep fields 0,1,4,5,6 trimmed, 64-bit id.

    Lines with fewer than 7 fields or a non-numeric id are dropped (or kept with
    ``_bad=true`` when ``keep_bad``). Empty trailing tags are accepted as ''.
    """
    parts = F.split(F.col(col), r"\^")
    f = lambda i: F.try_element_at(parts, F.lit(i + 1))
    out = lines.select(
        F.trim(f(0)).try_cast("bigint").alias("productId"),
        F.trim(f(1)).alias("name"),
        F.trim(f(4)).alias("imageUrl"),
        F.trim(f(5)).alias("categories"),
        F.trim(f(6)).alias("tags"),
        (F.size(parts) < 7).alias("_short"))
    bad = F.col("_short") | F.col("productId").isNull()
    if keep_bad:
        return out.withColumn("_bad", bad).drop("_short")
    return out.where(~bad).drop("_short")


def parse_rating_lines(lines: DataFrame, col: str = "value", keep_bad: bool = False) -> DataFrame:
    """S2: 'user,product,score,ts' without header; malformed lines dropped."""
    parts = F.split(F.col(col), ",")
    f = lambda i: F.trim(F.try_element_at(parts, F.lit(i + 1)))
    out = lines.select(f(0).try_cast("bigint").alias("userId"), f(1).try_cast("bigint").alias("productId"),
                       f(2).try_cast("double").alias("score"), f(3).try_cast("bigint").alias("timestamp"))
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in out.columns])
    return out.withColumn("_bad", bad) if keep_bad else out.where(~bad)


def read_product_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_product_lines(spark.read.text(path))


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    return parse_rating_lines(spark.read.text(path))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """The application log as plain lines."""
    return spark.read.text(path)


def filter_log(lines: DataFrame, col: str = "value") -> DataFrame:
    """St1 (P5, P6): keep lines with the rating prefix, emit the trimmed payload."""
    return lines.where(X.contains_prefix(F.col(col))).select(X.after_prefix(F.col(col)).alias("value"))


def parse_messages(msgs: DataFrame, col: str = "value") -> DataFrame:
    """St2 (P7): payload -> (userId, productId, score, timestamp); bad payloads dropped."""
    cols = X.parse_rating_message(F.col(col))
    out = msgs.select(*[v.alias(k) for k, v in cols.items()])
    return out.dropna(subset=list(cols))


def log_filter_parse(lines: DataFrame, col: str = "value") -> DataFrame:
    return parse_messages(filter_log(lines, col))
