"""Quality rules (operator 5): a text's character-class and common-word histograms against language references.

References are learned in one pass over all rows with a lang: per language the shares of ``CLASSES`` character
classes, and the words holding at least ``COMMON_SHARE`` of the language's words (so at most 1 / COMMON_SHARE of
them, whatever the corpus) with one cell for all others. A text is judged by its Jensen-Shannon distance (base 2,
0 to 1) to the nearest reference, and only by histograms it is long enough for: ``MIN_CHARS`` and ``MIN_WORDS``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolib.llm.common import fresh_name, stored

COMMON_SHARE = 0.004
MIN_CHARS, MIN_WORDS = 200, 50
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.30, 0.42
MAX_LANGS = 2_000  # of references sent to every task, each of at most 1 / COMMON_SHARE words
FLUSH_WORDS = 500_000  # distinct words a training task holds before it hands its counts on
SYMBOLS = "#*$%&|<>"
CLASSES = 11
RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, char_distance double, word_distance double")


@lru_cache(maxsize=1)
def _class_table() -> np.ndarray:
    """Class of each code point: 0 ASCII white space, 1 symbols, 2 a-z, 3 A-Z, 4 0-9, 5 sentence marks, 6 other
    ASCII, 7 other lower-case letters, 8 other upper-case letters, 9 other letters, 10 the rest."""
    t = np.full(0x110000, 10, np.uint8)
    for i in range(0x80, 0x110000):
        c = chr(i)
        if c.isalpha():
            t[i] = 7 if c.islower() else 8 if c.isupper() else 9
    t[:0x80] = 6
    t[[32, *range(9, 14)]] = 0
    t[ord("a"):ord("z") + 1], t[ord("A"):ord("Z") + 1], t[ord("0"):ord("9") + 1] = 2, 3, 4
    t[[ord(c) for c in ".,;:'\"!?()-"]] = 5
    t[[ord(c) for c in SYMBOLS]] = 1
    return t


def class_counts(text: str) -> np.ndarray:
    return np.bincount(_class_table()[np.frombuffer(text.encode("utf-32-le"), "<u4")], minlength=CLASSES)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in the text."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = x[:-1] * len(ids) + x[1:]
    if len(ids) >= 1 << 20:  # keep the three-word key inside 64 bits
        pair = np.unique(pair, return_inverse=True)[1]
    _, inverse, n = np.unique(pair[:-1] * len(ids) + x[2:], return_inverse=True, return_counts=True)
    twice = n[inverse] > 1
    hit = np.zeros(len(words), bool)
    hit[:-2] |= twice
    hit[1:-1] |= twice
    hit[2:] |= twice
    return int(hit.sum())


def dup_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = Counter(text.split("\n"))
    return sum(n - 1 for line, n in lines.items() if n > 1 and line.encode().split())


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two distributions, base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0.0) + np.where(q > 0, q * np.log2(q / m), 0.0)
    return float(np.sqrt(max(0.0, d.sum() / 2)))


class Reference:
    """One language's distributions."""

    def __init__(self, classes: np.ndarray, words: dict[str, int], n_words: int) -> None:
        self.classes = classes / max(1, classes.sum())
        self.at = {w.encode(): k for k, w in enumerate(sorted(words))}
        n = np.array([words[w] for w in sorted(words)] + [n_words - sum(words.values())], float)
        self.words = n / max(1, n_words)

    def word_distance(self, words: Counter) -> float:
        n = np.zeros(len(self.words))
        for w, k in self.at.items():
            n[k] = words[w]
        total = words.total()
        n[-1] = total - n.sum()
        return js_distance(n / total, self.words)


def learn(docs: DataFrame) -> dict[str, Reference]:
    """References by lang, over all rows of ``docs`` with a lang and a text. No such rows: no references."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def held() -> pd.DataFrame:
            rows = [(lang, w.decode(), n) for lang, c in words.items() for w, n in c.items()]
            words.clear()
            return pd.DataFrame(rows, columns=["lang", "word", "n"])

        for pdf in batches:
            for text, lang in zip(pdf["text"], pdf["lang"]):
                words.setdefault(lang, Counter()).update(text.encode().lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                if sum(map(len, words.values())) > FLUSH_WORDS:
                    yield held()
        yield held()
        # a class count stands beside the words under a key no word can be
        yield pd.DataFrame([(lang, f" {k}", int(n)) for lang, v in classes.items() for k, n in enumerate(v) if n],
                           columns=["lang", "word", "n"])

    labelled = docs.select("text", "lang").where("text is not null and lang is not null")
    counts = stored(labelled.mapInPandas(count, "lang string, word string, n long")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "reference-words")
    is_class = F.col("word").startswith(" ")
    totals = {r.lang: r.n for r in counts.where(~is_class).groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes: dict[str, np.ndarray] = {}
    for r in counts.where(is_class).collect():
        classes.setdefault(r.lang, np.zeros(CLASSES))[int(r.word)] = r.n
    if len(classes) > MAX_LANGS:
        raise ValueError(f"{len(classes)} languages; at most {MAX_LANGS} references are sent to the tasks")
    floor = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, n * COMMON_SHARE)]) if totals else None
    common: dict[str, dict[str, int]] = {}
    if totals:
        for r in counts.where(~is_class & (F.col("n") >= floor[F.col("lang")])).collect():
            common.setdefault(r.lang, {})[r.word] = r.n
    return {lang: Reference(v, common.get(lang, {}), totals.get(lang, 0)) for lang, v in sorted(classes.items())}


def judge(text: str | None, references: list[Reference]) -> tuple:
    """The counts and verdict of one whole text (null: no words)."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    classes = class_counts(text)
    repeats = repeat_words(words)
    failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    chars = word = None
    if references and len(text) >= MIN_CHARS:
        share = classes / classes.sum()
        chars = min(js_distance(share, r.classes) for r in references)
    if references and len(words) >= MIN_WORDS:
        lower = Counter(raw.lower().split())
        word = min(r.word_distance(lower) for r in references)
    far = (chars is not None and chars > MAX_CHAR_DISTANCE) or (word is not None and word > MAX_WORD_DISTANCE)
    return (len(words), len(text) - int(classes[0]), int(classes[1]), dup_lines(text), repeats, failed,
            not failed and not far, chars, word)


def verdict(text: Column, references: dict[str, Reference]) -> Column:
    """Struct column of ``RESULT`` for a text column."""
    from pyspark.sql import SparkSession

    shared = SparkSession.active().sparkContext.broadcast(list(references.values()))
    names = [f.split()[0] for f in RESULT.split(", ")]

    @F.pandas_udf(RESULT)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = pd.DataFrame([judge(t, shared.value) for t in texts], columns=names)
            yield out.astype({"char_distance": float, "word_distance": float})

    return judged(text)


def quality(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the counts, base_failed, kept, and the two distances (null below the length
    guards or without references).

    A null or empty text has no words and fails the base rule; a null lang teaches nothing but its row is judged;
    repeated rows each give a row; an empty table gives none. Other columns are ignored."""
    d = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    return d.select("doc_id", verdict(F.col("text"), learn(d)).alias("q")).select("doc_id", "q.*")


def kept_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    tmp = fresh_name(docs.columns, "quality")
    references = learn(docs.select("text", F.col("lang").cast("string").alias("lang")))
    return docs.withColumn(tmp, verdict(F.col("text"), references)).where(F.col(f"{tmp}.kept")).drop(tmp)
