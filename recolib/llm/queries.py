"""The registered queries of this package: one per operator, over the whole ``documents`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recolib.llm import (bpe, divergence, hmm, imatch, langid, linededup, merkle, mixing, neardup, quality, secrets,
                         substrings, tokenfile)
from recolib.llm.common import documents


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_ids(documents(spark, sf_dir))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.lm_scores(documents(spark, sf_dir))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.found_secrets(documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    return tokenfile.token_file_digests(documents(spark, sf_dir), vocab.path("byte_bpe_50k.json"), vocab.PATTERN, 2)


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as vocab

    return bpe.bpe_digests(documents(spark, sf_dir), vocab.path("byte_bpe_50k.tiktoken"), vocab.PATTERN)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(documents(spark, sf_dir))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_language_id, op2_lm_scores, op3_source_mix, op4_secret_scan, op5_quality_rules,
                            op6_fingerprints, op7_repeated_substrings, op8_token_files, op9_bpe_round_trip,
                            op10_near_duplicates, op11_source_divergence, op12_merkle_manifest, op13_line_dedup)
}

SQL: dict[str, str] = {"op3_source_mix": mixing.SQL, "op11_source_divergence": divergence.SQL,
                       "op12_merkle_manifest": merkle.SQL, "op13_line_dedup": linededup.SQL}
