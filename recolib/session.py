"""Session helpers: a tuned local session for tests and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes; applied on top of whatever the cluster sets.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "recolib", driver_memory: str = "16g",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench (a cluster brings its own)."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # checkpointed intermediates are removed once nothing references them
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**SQL_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir); only when
    neither is set (tests on one machine) is a local folder created and set.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="recolib-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    unless the session itself names a local folder)."""
    base = _scope.get() or ensure_checkpoint_dir(spark).rstrip("/") + "/recolib"
    return "/".join([base, *parts, uuid.uuid4().hex])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Scratch paths made inside lie in one folder that is removed at the end (a micro-batch's intermediates)."""
    folder = scratch_path(spark, "scope")
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later branches scan pruned columns of the files,
    and a lost executor costs a reread, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished step when the driver collects its plan, which may be long after the
    step's result was stored. Collecting now keeps the files of several large steps from lying on the disks together."""
    spark.sparkContext._jvm.System.gc()


__all__ = ["build_session", "ensure_checkpoint_dir", "free_shuffles", "scratch_path", "scratch_scope", "stored", "SQL_DEFAULTS"]
