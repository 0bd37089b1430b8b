"""Language identification (operator 1): multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, every character that is no letter becomes a space, and all 1- to 3-character windows that
start on a letter (or on the space before one) are hashed into ``CELLS`` cells. Training counts cells per language in numpy, one
partition at a time, and adds the partitions up with a grouped sum, so a language holding most rows is summed from
one partial row per cell and partition. The smoothed log-probability matrix has a size fixed by ``CELLS`` and the
number of languages, which is checked before it is broadcast. Scoring gathers the rows of a text's cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolib.llm.common import columns, id_remainder

CELLS = 1 << 16
SMOOTHING = 0.5
MAX_MODEL_BYTES = 256 << 20
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter (Unicode category L)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def cells(text: str | None) -> np.ndarray:
    """Hashed n-gram cells of a whole text; empty when it is null or has no letter."""
    if not text:
        return np.empty(0, np.uint32)
    cp = np.frombuffer(f" {text.lower()}  ".encode("utf-32-le"), "<u4")
    letter = _letters()[cp]
    x = np.where(letter, cp, np.uint32(32))
    a, b, c = x[:-2], x[1:-1], x[2:]
    mid = np.flatnonzero(letter[1:-1])
    if not len(mid):
        return np.empty(0, np.uint32)
    a, b, c = a[mid], b[mid], c[mid]
    one = b * np.uint32(0x9E3779B1)
    two = (one ^ (b >> np.uint32(7))) + c * np.uint32(0x85EBCA77) + np.uint32(0x2545F491)
    three = two * np.uint32(5) + a * np.uint32(0xC2B2AE3D) + np.uint32(0x27D4EB2F)
    h = np.concatenate([one, two * np.uint32(0x9E3779B1), three * np.uint32(0x9E3779B1)])
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their ``CELLS`` x languages matrix of log probabilities; its last row
    holds the log priors. Rows with a null lang or text teach nothing; no rows give no languages."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                v = sums.setdefault(lang, np.zeros(CELLS + 1, np.int64))
                v[:CELLS] += np.bincount(cells(text), minlength=CELLS)
                v[CELLS] += 1
        for lang, v in sums.items():
            cell = np.flatnonzero(v)
            yield pd.DataFrame({"lang": lang, "cell": cell, "n": v[cell]})

    labelled = docs.select("text", "lang").where("text is not null and lang is not null")
    counts = (labelled.mapInPandas(count, "lang string, cell long, n long")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    langs = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if 4 * len(langs) * (CELLS + 1) > MAX_MODEL_BYTES:
        raise ValueError(f"{len(langs)} languages x {CELLS} cells exceed {MAX_MODEL_BYTES} bytes")
    model = np.full((CELLS + 1, len(langs)), 0.0)
    at = {lang: k for k, lang in enumerate(langs)}
    table = columns(counts)
    model[table["cell"], [at[x] for x in table["lang"]]] = table["n"]
    seen = model[:CELLS] + SMOOTHING
    model[:CELLS] = np.log(seen) - np.log(seen.sum(axis=0))
    if langs:
        model[CELLS] = np.log(model[CELLS] / model[CELLS].sum())
    return langs, model.astype(np.float32)


def predict(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """``docs`` with a struct column ``language`` (lang_pred, score) from the text alone.

    ``score`` is the posterior of the predicted language. A null or letterless text, or an empty model, gives
    ``und`` and 0; on equal posteriors the first language by code point wins."""
    shared = docs.sparkSession.sparkContext.broadcast((langs, model))

    @F.pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names, logp = shared.value
        for texts in batches:
            rows = []
            for text in texts:
                c = cells(text)
                if not len(c) or not names:
                    rows.append((UNDETERMINED, 0.0))
                    continue
                if len(c) < CELLS:
                    total = logp[c].sum(axis=0, dtype=np.float64)
                else:
                    total = np.bincount(c, minlength=CELLS) @ logp[:CELLS].astype(np.float64)
                total += logp[CELLS]
                best = int(total.argmax())
                rows.append((names[best], float(1.0 / np.exp(total - total[best]).sum())))
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return docs.withColumn("language", classify(F.col("text")))


def language_ids(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    Learns from rows whose crc32(doc_id) mod 4 is not 2. A null doc_id hashes as empty text and is kept; repeated
    rows each give a row; an empty table gives none; other columns are ignored."""
    d = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"),
                    (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out"))
    langs, model = train(d.where("not held_out"))
    out = predict(d.select("doc_id", "held_out", "text"), langs, model)
    return out.select("doc_id", "held_out", "language.lang_pred", "language.score")
