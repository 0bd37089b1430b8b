"""The training-data pipeline over ``documents``: quality rules, near-duplicate removal, secret redaction, source mixing
and byte-level BPE. Each stage gets what its predecessor kept; all but the last return the columns they were given."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recolib.llm import bpe, mixing, neardup, quality, secrets
from recolib.llm.common import documents, shared_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the rules keep; references are learned from the rows given."""
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that of smallest doc_id, of rows sharing the id that of one text. Rows
    without a word all stay."""
    return neardup.deduplicated(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every pattern and entropy span replaced by a mark; n_chars follows the text. A null text stays null, an empty one
    empty; repeated rows each stay."""
    clean = docs.withColumn("text", secrets.redacted(F.col("text")))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be never."""
    return mixing.mixed_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text, their number, and whether decoding them gives the text's bytes. A null
    or empty text has no ids; repeated rows each give a row."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = docs.select("doc_id", "lang", "source", bpe.encode_column(F.col("text"), ranks, pattern).alias("e"))
    return encoded.select("doc_id", "lang", "source", "e.ids", F.size("e.ids").cast("long").alias("n_tokens"),
                          "e.round_trip")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_redaction", secret_redaction),
    ("source_mixing", source_mixing),
    ("bpe_encoding", bpe_encoding),
]

# SQL can express neither the classes nor the ids; tests/llm/test_pipeline.py has a brute-force version of each stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written as Parquet in the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
