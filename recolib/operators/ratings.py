"""Rating ingest (U1, V7, P15): upsert rating events into the rating table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolib.functions import columns as X


def latest_per_pair(events: DataFrame) -> DataFrame:
    """Per (user, item): the newest score by (timestamp, event_id) and the
    earliest timestamp -> (userId, productId, score, first_ts)."""
    return events.groupBy("userId", "productId").agg(
        F.max_by("score", F.struct("timestamp", "event_id")).alias("score"),
        F.min("timestamp").alias("first_ts"))


def ingest(raw: DataFrame) -> DataFrame:
    """V7's incoming ratings (event_id, userId, productId, raw, ms): the UI score 1..10 normalised (P14), milliseconds
    to seconds (P15), and the log line that goes out (S14) -> rating events plus ``line``.

    The result is what the recent queue (W2) and :func:`upsert_ratings` (U1) take."""
    out = raw.select("event_id", "userId", "productId", X.normalise_score("raw").alias("score"),
                     X.ms_to_seconds("ms").alias("timestamp"))
    return out.withColumn("line", X.format_rating_log("userId", "productId", "score", "timestamp"))


def upsert_ratings(base: DataFrame, events: DataFrame) -> DataFrame:
    """U1 in bulk: a pair new to ``base`` is inserted with its first event time;
    an existing pair keeps its stored timestamp and takes the newest score.

    Pairs untouched by the events pass through unchanged (duplicates included);
    a touched pair with several stored rows becomes one row with the earliest
    stored timestamp. A null user or product equals no other. Output timestamps are
    epoch seconds (bigint). ``base`` is read and shuffled once: the one row per pair of
    the events goes to the stored rows of its pair.
    """
    keys = ["userId", "productId"]
    seconds = F.col("timestamp").cast("bigint").alias("timestamp")
    new = latest_per_pair(events).withColumnRenamed("first_ts", "timestamp").select(*keys, "score", seconds, F.lit(True).alias("_new"))
    rows = base.select(*keys, "score", seconds, F.lit(False).alias("_new")).unionByName(new)
    paired = F.col("userId").isNotNull() & F.col("productId").isNotNull()
    # rows that are in no pair are dealt by their values, not sent to one task
    rows = rows.withColumn("_alone", F.when(~paired, F.xxhash64(*keys, "score", "timestamp")))
    pair = Window.partitionBy(*keys, "_alone")
    rows = rows.select(*keys, "score", "timestamp", "_new", (paired & F.max("_new").over(pair)).alias("_touched"),
                       F.min(F.when(paired & ~F.col("_new"), F.col("timestamp"))).over(pair).alias("_base_ts"))
    return rows.where(F.col("_new") | ~F.col("_touched")).select(
        *keys, "score", F.when(F.col("_new"), F.coalesce("_base_ts", "timestamp")).otherwise(F.col("timestamp")).alias("timestamp"))
