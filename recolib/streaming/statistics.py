"""Popularity statistics kept up by the rating stream (A1-A3 and with them T1, T6, T7, V1, V2).

One table of totals by (productId, yearmonth) holds all three: rows, rows with a score, and the sum of the scores. They
merge by addition, so counts, counts by month and means are views of it. A streaming aggregation in update mode keeps
the totals in Spark's state store, and each batch writes only the totals that it changed.

* Rows count however late they come: a state row belongs to a product and a month and is never dropped, so the state
  grows with products and months, not with ratings.
* A batch goes to ``totals/batch_id=N`` with overwrite; a retried batch writes the same rows again.
* ``base`` (ratings from before the stream) is summed once, into a folder of its own, and added when totals are read.
* ``compact_every=k`` writes the newest totals of all keys as one version every k batches; readers start from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolib import config as C
from recolib.functions import columns as X
from recolib.streaming.user_state import rocksdb_state

KEYS = ["productId", "yearmonth"]
_TOTALS = "productId long, yearmonth string, n long, scored long, total double"


def totals(ratings: DataFrame) -> DataFrame:
    """(productId, yearmonth, n, scored, total) of ratings, a table or a stream. Rows without a product are not counted."""
    rows = ratings.where(F.col("productId").isNotNull())
    return rows.groupBy("productId", X.year_month("timestamp").alias("yearmonth")).agg(
        F.count(F.lit(1)).alias("n"), F.count("score").alias("scored"), F.sum("score").alias("total"))


def rate_more_products(current: DataFrame) -> DataFrame:
    """A1 from totals."""
    return current.groupBy("productId").agg(F.sum("n").alias("count"))


def rate_more_recently_products(current: DataFrame) -> DataFrame:
    """A2 from totals."""
    return current.select("productId", F.col("n").alias("count"), "yearmonth")


def average_products(current: DataFrame) -> DataFrame:
    """A3 from totals; null where no rating of the product has a score, as an average gives."""
    return current.groupBy("productId").agg(F.try_divide(F.sum("total"), F.sum("scored")).alias("avg"))


class StatisticsJob:
    def __init__(self, spark: SparkSession, folder: str, base: DataFrame | None = None,
                 compact_every: int | None = None) -> None:
        self.spark, self.folder, self.base, self.compact_every = spark, folder.rstrip("/"), base, compact_every

    def _there(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def process_batch(self, changed: DataFrame, batch_id: int) -> None:
        """Write the changed totals of a micro-batch. One without rating events leaves an empty version."""
        changed.write.mode("overwrite").parquet(f"{self.folder}/totals/batch_id={batch_id}")
        if self.compact_every and (batch_id + 1) % self.compact_every == 0:
            self._streamed(batch_id).write.mode("overwrite").parquet(f"{self.folder}/compacted/upto={batch_id}")

    def start(self, source: DataFrame, checkpoint: str, available_now: bool = True):
        """Start, or resume from ``checkpoint``, the statistics of a stream of rating events."""
        if self.base is not None and not self._there("base/_SUCCESS"):
            totals(self.base).write.mode("overwrite").parquet(f"{self.folder}/base")
        w = (totals(source).writeStream.outputMode("update").foreachBatch(self.process_batch)
             .option("checkpointLocation", checkpoint))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=C.STREAM_TRIGGER)
        with rocksdb_state(self.spark):
            return w.start()

    def _streamed(self, upto: int | None = None) -> DataFrame:
        """Each key's newest totals among the batches (up to ``upto``): the newest compaction and the batches after it."""
        versions = self.spark.read.schema(f"{_TOTALS}, batch_id int").parquet(f"{self.folder}/totals")
        if upto is not None:
            versions = versions.where(F.col("batch_id") <= upto)
        if self._there("compacted"):
            whole = self.spark.read.schema(f"{_TOTALS}, upto int").parquet(f"{self.folder}/compacted")
            older = whole.where(F.col("upto") < upto) if upto is not None else whole
            newest = older.agg(F.max("upto")).first()[0]
            if newest is not None:
                versions = versions.where(F.col("batch_id") > newest).unionByName(
                    whole.where(F.col("upto") == newest).withColumnRenamed("upto", "batch_id"))
        # totals only grow, but not so their parts with a null score: the batch decides
        return versions.groupBy(*KEYS).agg(*[F.max_by(c, "batch_id").alias(c) for c in ("n", "scored", "total")])

    def current_totals(self) -> DataFrame:
        """(productId, yearmonth, n, scored, total) of the base ratings and all batches so far."""
        parts = [self._streamed()] if self._there("totals") else []
        if self._there("base/_SUCCESS"):
            parts.append(self.spark.read.schema(_TOTALS).parquet(f"{self.folder}/base"))
        if not parts:
            return self.spark.createDataFrame([], _TOTALS)
        if len(parts) == 1:
            return parts[0]
        both = parts[0].unionByName(parts[1])
        return both.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n", "scored", "total")])


__all__ = ["StatisticsJob", "average_products", "rate_more_products", "rate_more_recently_products", "totals"]
