"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recolib.session import ensure_checkpoint_dir

# A word is a run of characters other than ASCII white space. ``bytes.split()`` cuts UTF-8 at exactly these.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later branches scan the files, and a lost
    executor costs a reread instead of a recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished step when the driver collects its plan, which may be long after the
    step's result was stored. Collecting now keeps the files of several large steps from lying on the disks together."""
    spark.sparkContext._jvm.System.gc()


def columns(df: DataFrame) -> dict[str, np.ndarray]:
    """A bounded result on the driver, as one numpy array per column. It travels as Arrow batches, never as rows."""
    table = df.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also where a lambda in ``body`` reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh_name(taken: Iterable[str], base: str) -> str:
    """A column name that none of ``taken`` equals, whatever the case of its letters."""
    used, name = {c.lower() for c in taken}, base
    while name.lower() in used:
        name += "_"
    return name
