"""The rating table as buckets of users, changed by batches of events.

A batch rewrites the buckets of its own users and leaves the files of the others as they are. New files go to a folder
of their own; then one numbered pointer names the folder of every bucket, so readers see a batch whole or not at all. The
pointer also holds the newest batch number: a batch that comes again changes nothing. Batches come in ascending numbers
from one writer; if another writer was faster, the call raises and may be repeated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from recolib.operators.ratings import upsert_ratings
from recolib.session import scratch_scope, stored
from recolib.sources.results import Pointers

_SCHEMA = "userId long, productId long, score double, timestamp long"


class RatingTable(Pointers):
    def __init__(self, spark, root: str, buckets: int = 64) -> None:
        """``buckets`` is fixed when the table is made; choose it so that one holds a few files."""
        super().__init__(spark, root)
        self.buckets = buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col("userId").cast("long")), F.lit(self.buckets)).cast("int")

    def _write(self, ratings: DataFrame) -> dict[str, str]:
        """The folder that holds each bucket with rows. A large bucket, as of a hot user, becomes several files."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = ratings.selectExpr("userId", "productId", "CAST(score AS DOUBLE) AS score",
                                  "CAST(timestamp AS BIGINT) AS timestamp").withColumn("bucket", self._bucket())
        rows.hint("rebalance", "bucket").write.option("compression", "zstd").partitionBy("bucket").parquet(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in self._fs().listStatus(self._path(folder))]
        return {n.removeprefix("bucket="): f"{folder}/{n}" for n in names if n.startswith("bucket=")}

    def _state(self) -> tuple[int, dict]:
        newest = max(self.versions(), default=0)
        return newest, self._read(newest) if newest else {"batch": None, "buckets": {}}

    def create(self, ratings: DataFrame) -> None:
        """The first content; raises if there is a table already."""
        if self.versions() or not self._add_pointer(1, {"batch": None, "buckets": self._write(ratings)}):
            raise RuntimeError(f"there is a rating table under {self.root} already")

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(*[f"{self.root}/{f}" for f in folders])

    def read(self, users: list[int] | None = None) -> DataFrame:
        """The ratings as of now; of ``users``, whose buckets alone are opened, if named."""
        of = self._state()[1]["buckets"]
        if users is None:
            return self._rows(list(of.values()))
        ids = self.spark.createDataFrame([(int(u),) for u in users], "userId long")
        asked = {str(r[0]) for r in ids.select(self._bucket()).distinct().collect()}
        return self._rows([f for b, f in of.items() if b in asked]).where(F.col("userId").isin([int(u) for u in users]))

    def apply(self, events: DataFrame, batch_id: int) -> bool:
        """Upsert a batch (event_id, userId, productId, score, timestamp) as :func:`upsert_ratings` does; events without
        a user or a product are not ratings. False if the batch is known already. Fits ``foreachBatch``."""
        version, state = self._state()
        if state["batch"] is not None and batch_id <= state["batch"]:
            return False
        with scratch_scope(self.spark):
            new = stored(events.select("event_id", "userId", "productId", "score", "timestamp")
                         .dropna(subset=["userId", "productId"]), "events")
            touched = {str(r[0]) for r in new.select(self._bucket()).distinct().collect()}  # at most all buckets
            base = self._rows([f for b, f in state["buckets"].items() if b in touched])
            written = self._write(upsert_ratings(base, new)) if touched else {}
        if not self._add_pointer(version + 1, {"batch": batch_id, "buckets": {**state["buckets"], **written}}):
            raise RuntimeError(f"another writer changed the table under {self.root}; repeat the batch")
        return True


__all__ = ["RatingTable"]
