"""Hidden Markov language model over words (operator 2).

Counting: every task counts its words; a grouped sum gives each word's count over all training documents.

Symbols: words with at least 1 / ``SYMBOL_WORDS`` of all tokens are symbols of their own (so at most that many); any
other word emits the class of its last three letters, and its share of the class, which no state changes. Of a
class's mass each known word gives up ``DISCOUNT`` counts to words never seen. Symbols, transition and emission
tables have sizes fixed by these parameters and are sent to every task.

Training: Baum-Welch. Each pass runs the scaled forward and backward recursions over all training documents, many
documents side by side in numpy, and adds expected counts up with a grouped sum. The first parameters are a seeded guess
around the words' shares; every pass covers all training documents, whose symbols are looked up and written once.

Scoring: the scaled forward recursion gives the exact likelihood of a document's symbols. Counts of the words with at
least 1 / ``TABLE_WORDS`` of all tokens are sent to the tasks; the rest, rare by construction, are joined by word.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolib.llm.common import ASCII_LOWER, columns, id_remainder, stored

STATES = 8
SYMBOL_WORDS = 1 << 15
TABLE_WORDS = 1 << 19
CLASSES = 1 << 11
DISCOUNT = 0.5
PASSES = 6  # over all training documents
SEGMENT = 512  # training splits longer documents into pieces of so many tokens; scoring does not
SMOOTHING = 50.0
SCALED = 8  # steps between scalings of the recursions: probabilities of so many symbols stay far above the least double
FLUSH_WORDS = 200_000
MAX_ENDINGS = 200_000  # word endings a worker remembers the class of
SCORED_ROWS = 500  # documents whose rare words are held at a time


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(ASCII_LOWER).split()


_classes: dict[bytes, int] = {}


def class_of(word: bytes) -> int:
    """Class of a word by its last three characters; equals Spark's xxhash64(right(word, 3)) modulo CLASSES."""
    end = word[-3:]
    if not end.isascii():
        end = word.decode()[-3:].encode()
    out = _classes.get(end)
    if out is None:
        if len(_classes) >= MAX_ENDINGS:
            _classes.clear()
        out = _classes[end] = xxhash.xxh64_intdigest(end, seed=42) % CLASSES
    return out


class Symbols(dict):
    """Word -> symbol: its own, or that of its class, which is kept ready for the words of the count table."""

    def __init__(self, own: dict[bytes, int], table: Iterable[bytes]) -> None:
        super().__init__((w, len(own) + class_of(w)) for w in table)
        self.update(own)
        self.first_class = len(own)

    def __missing__(self, word: bytes) -> int:
        return self.first_class + class_of(word)


class Model:
    """pi (S), a (S x S) and emissions by symbol (M x S)."""

    def __init__(self, pi: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        self.pi, self.a, self.b = pi, a, b

    def forward(self, seqs: list[np.ndarray], keep: bool = False):
        """Natural log likelihood of each sequence (of at least one symbol), and with ``keep`` what backward needs.

        Symbols are laid out step by step, those of the sequences still going on side by side, so that every step reads
        and writes one run of rows. Rows are scaled to a sum of 1 every ``SCALED`` steps and at a sequence's end."""
        size = np.array([len(s) for s in seqs])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        active = np.searchsorted(-size, -np.arange(size[0]), side="left")  # sequences longer than t come first
        first = np.cumsum(active) - active
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        flat = np.empty(len(step), np.intp)
        flat[first[step] + np.repeat(np.arange(len(size)), size)] = np.concatenate([seqs[i] for i in order])
        del step
        log, ones, scales = np.zeros(len(seqs)), np.ones(STATES), []
        if keep:
            emit = self.b.take(flat, axis=0)
            alphas = np.empty_like(emit)
        alpha = None
        for t, n in enumerate(active.tolist()):
            rows = slice(first[t], first[t] + n)
            b = emit[rows] if keep else self.b.take(flat[rows], axis=0)
            now = alphas[rows] if keep else np.empty_like(b)
            if t:
                np.matmul(alpha[:n], self.a, out=now)
                now *= b
            else:
                np.multiply(self.pi, b, out=now)
            alpha = now
            low = 0 if t % SCALED == 0 or t + 1 == len(active) else active[t + 1]
            c = now[low:] @ ones
            now[low:] /= c[:, None]
            log[low:n] += np.log(c)
            if keep:
                scales.append((low, c))
        out = np.empty(len(seqs))
        out[order] = log
        return (out, flat, first, active, alphas, emit, scales) if keep else out

    def expected(self, seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected first states (S), transitions (S x S) and emissions (M x S) of the sequences, and their log
        likelihood."""
        log, flat, first, active, gamma, emit, scales = self.forward(seqs, keep=True)
        moves, back = np.zeros_like(self.a), np.ascontiguousarray(self.a.T)
        beta = np.ones((len(seqs), STATES))
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            rows = slice(first[t], first[t] + n)
            gamma[rows] *= beta[:n]  # those of earlier steps are still the forward ones
            if t:
                low, c = scales[t]
                w = emit[rows]
                w *= beta[:n]
                w[low:] /= c[:, None]
                moves += gamma[first[t - 1]:first[t - 1] + n].T @ w
                np.matmul(w, back, out=beta[:n])
        starts = gamma[:active[0]].sum(axis=0)
        by_state = np.ascontiguousarray(gamma.T)
        emitted = np.stack([np.bincount(flat, g, len(self.b)) for g in by_state], axis=1)
        return starts, moves * self.a, emitted, float(log.sum())

    @staticmethod
    def fitted(first: np.ndarray, moves: np.ndarray, emitted: np.ndarray, prior: np.ndarray) -> Model:
        """Parameters from expected counts, smoothed towards the symbol shares ``prior``."""
        pi = (first + 1.0) / (first + 1.0).sum()
        a = moves + 0.1
        b = (emitted + SMOOTHING * prior[:, None]) / (emitted.sum(axis=0) + SMOOTHING)
        return Model(pi, a / a.sum(axis=1, keepdims=True), b)

    @staticmethod
    def guess(prior: np.ndarray, seed: int) -> Model:
        r = np.random.default_rng(seed)
        b = prior[:, None] * np.exp(r.normal(size=(len(prior), STATES)))
        a = np.full((STATES, STATES), 0.03 / max(1, STATES - 1))
        np.fill_diagonal(a, 0.97)
        return Model(np.full(STATES, 1 / STATES), a, b / b.sum(axis=0))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over the words of all rows; end tokens are not among them."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter = Counter()

        def rows() -> pd.DataFrame:
            out = pd.DataFrame({"word": [w.decode() for w in held], "n": list(held.values())})
            held.clear()
            return out

        for pdf in batches:
            for text in pdf["text"]:
                held.update(words_of(text))
                if len(held) > FLUSH_WORDS:
                    yield rows()
        if held:
            yield rows()

    return training.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Trained:
    """What scoring needs: totals, words with a symbol, counts of the table's words, class counts and the model."""

    def __init__(self, n: int, v: int, n_docs: int, own: dict[bytes, int], count: dict[bytes, int], class_n: np.ndarray,
                 class_v: np.ndarray, model: Model) -> None:
        self.n, self.v, self.n_docs, self.own, self.count = n, v, n_docs, own, count
        self.class_n, self.class_v, self.model = class_n, class_v, model


def sequence(words: list[bytes], symbols: Symbols, end: int) -> np.ndarray:
    """Symbols of a text's words, and the end."""
    out = np.full(len(words) + 1, end, np.int32)
    out[:-1] = np.fromiter(map(symbols.__getitem__, words), np.int32, len(words))
    return out


def sequences(texts, symbols: Symbols, end: int) -> list[np.ndarray]:
    return [sequence(words_of(text), symbols, end) for text in texts]


def batches_of(seqs: list[np.ndarray], tokens: int = 600_000) -> Iterator[list[np.ndarray]]:
    """Runs of sequences of about ``tokens`` symbols in all, so that kept recursions stay small."""
    held, n = [], 0
    for s in seqs:
        held.append(s)
        n += len(s)
        if n >= tokens:
            yield held
            held, n = [], 0
    if held:
        yield held


def train(training: DataFrame, counts: DataFrame) -> Trained:
    """Fit the model to the rows of ``training``; ``counts`` are its word counts."""
    spark = training.sparkSession
    n_docs = training.count()
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = (total.n or 0) + n_docs, total.v + (n_docs > 0)
    table = columns(counts.where(F.col("n") >= max(1, n / TABLE_WORDS)))
    top = sorted(zip(table["n"].tolist(), table["word"].tolist()), key=lambda r: (-r[0], r[1]))
    symbols = [(c, w) for c, w in top if c >= n / SYMBOL_WORDS]
    own = {w.encode(): k for k, (_, w) in enumerate(symbols)}
    end = len(own) + CLASSES
    rest = (counts.where(F.col("n") < n / SYMBOL_WORDS)
            .groupBy(F.expr(f"pmod(xxhash64(right(word, 3)), {CLASSES})").alias("k"))
            .agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect())
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in rest:
        # pmod of the signed hash; the unsigned one has the same remainder because CLASSES is a power of two
        class_n[r.k], class_v[r.k] = r.n, r.v
    prior = np.concatenate([[c for c, _ in symbols], class_n + 0.5, [n_docs + 0.5]])
    prior /= prior.sum()

    model = Model.guess(prior, 0)
    shared = spark.sparkContext.broadcast((own, [w.encode() for _, w in top]))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Symbols(*shared.value)
        for pdf in batches:
            yield pd.DataFrame({"symbols": [s.astype("<u2").tobytes() for s in sequences(pdf["text"], known, end)]})

    # there are at most SYMBOL_WORDS + CLASSES + 1 symbols, so 16 bits hold one
    encoded = stored(training.select("text").mapInPandas(encode, "symbols binary"), "symbols")
    for _ in range(PASSES if n_docs else 0):
        now = spark.sparkContext.broadcast(model)

        def expect(batches: Iterator[pd.DataFrame], now=now) -> Iterator[pd.DataFrame]:
            model = now.value
            sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((len(prior), STATES))]
            for pdf in batches:
                whole = [np.frombuffer(x, "<u2").astype(np.int32) for x in pdf["symbols"]]
                for part in batches_of([x[i:i + SEGMENT] for x in whole for i in range(0, len(x), SEGMENT)]):
                    for into, x in zip(sums, model.expected(part)):
                        into += x
            table = np.concatenate([sums[0][None, :], sums[1], sums[2]])
            at = np.flatnonzero(table.sum(axis=1) > 0)
            yield pd.DataFrame({"at": at, **{f"s{s}": table[at, s] for s in range(STATES)}})

        schema = "at long, " + ", ".join(f"s{s} double" for s in range(STATES))
        got = columns(encoded.mapInPandas(expect, schema).groupBy("at")
                      .agg(*[F.sum(f"s{s}").alias(f"s{s}") for s in range(STATES)]))
        table = np.zeros((1 + STATES + len(prior), STATES))
        for s in range(STATES):
            table[got["at"], s] = got[f"s{s}"]
        model = Model.fitted(table[0], table[1:1 + STATES], table[1 + STATES:], prior)
    return Trained(n, v, n_docs, own, {w.encode(): c for c, w in top}, class_n, class_v, model)


SCORED = ("row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
          "word string, n long")


def score(docs: DataFrame, counts: DataFrame, trained: Trained) -> DataFrame:
    """(row, doc_id, held_out, n_tokens, n_known, base_score, score) for ``docs`` (row, doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        symbols, end = Symbols(t.own, t.count), len(t.own) + CLASSES
        total, least = math.log10(t.n + 0.1 * (t.v + 1)), t.n / SYMBOL_WORDS
        for batch in batches:
            rows = batch["row"].to_pylist()
            seqs, n_tokens, n_known, base_score, extra_score = [], [], [], [], []
            rare_row, rare_word, rare_n = [], [], []
            for k, text in enumerate(batch["text"]):
                words = words_of(text.as_py())
                times = Counter(words)
                keys = list(times)
                n = np.fromiter(times.values(), np.int64, len(keys))
                seqs.append(sequence(words, symbols, end))
                c = np.array(list(map(t.count.get, keys)), float)  # nan: not in the table
                missing = np.isnan(c)
                known = int(n[~missing].sum())
                base = float((n * np.log10(c + 0.1))[~missing].sum()) + math.log10(t.n_docs + 0.1) - (known + 1) * total
                shared_class = np.flatnonzero(c < least)
                whole = t.class_n[[symbols[keys[i]] - len(t.own) for i in shared_class]] if len(shared_class) else 1.0
                extra = float((n[shared_class] * np.log10((c[shared_class] - DISCOUNT) / whole)).sum())
                lost = np.flatnonzero(missing).tolist()
                rare_row += [rows[k]] * len(lost)
                rare_word += [keys[i] for i in lost]
                rare_n += n[lost].tolist()
                n_tokens.append(len(words) + 1)
                n_known.append(known + (t.n > 0))
                base_score.append(base)
                extra_score.append(extra)
                if rare_row and (k + 1 == len(rows) or (k + 1) % SCORED_ROWS == 0):
                    yield filled(len(rare_row), row=rare_row, word=pa.array(rare_word, pa.binary()).cast(pa.string()), n=rare_n)
                    rare_row, rare_word, rare_n = [], [], []
            if rows:
                log = np.concatenate([t.model.forward(part) for part in batches_of(seqs, 4_000_000)]) / np.log(10)
                yield filled(len(rows), row=batch["row"], doc_id=batch["doc_id"], held_out=batch["held_out"], n_tokens=n_tokens,
                             n_known=n_known, base_score=base_score, score=log + extra_score)

    def filled(size: int, **known) -> pa.RecordBatch:
        """``size`` rows of ``SCORED``, null in the columns not given."""
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}
        fields = [(f.split()[0], kinds[f.split()[1]]) for f in SCORED.split(", ")]
        return pa.record_batch([known[f] if isinstance(known.get(f), pa.Array) else pa.array(known[f], kind) if f in known
                                else pa.nulls(size, kind) for f, kind in fields], [f for f, _ in fields])

    out = stored(docs.mapInArrow(run, SCORED), "scores")
    done = out.where("word is null").drop("word", "n")
    total = float(trained.n + 0.1 * (trained.v + 1))
    classes = docs.sparkSession.createDataFrame(
        [(k, float(trained.class_n[k]), float(trained.class_v[k])) for k in range(CLASSES)], "k long, class_n double, class_v double")
    rare = (out.where("word is not null").select("row", "word", "n")
            .join(counts.select("word", F.col("n").alias("c")), "word", "left")
            .withColumn("c", F.coalesce("c", F.lit(0)))
            .withColumn("k", F.expr(f"pmod(xxhash64(right(word, 3)), {CLASSES})"))
            .join(F.broadcast(classes), "k"))  # CLASSES rows
    known = F.col("c") - DISCOUNT
    share = F.when(F.col("class_n") == 0, 0.0).otherwise(F.log10(
        F.when(known > 0, known).otherwise(DISCOUNT * F.col("class_v")) / F.col("class_n")))
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.1) / total)).alias("more_base"),
        F.sum(F.col("n") * share).alias("more_score"))
    return done.join(more, "row", "left").select(
        "row", "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32(doc_id) mod 10 is not 0. A null text is empty and has its end token only; a null
    doc_id hashes as empty text; repeated rows each give a row; an empty table gives none. Without training rows every
    base term is log10(1) and the model is its smooth start. Other columns are ignored."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    (id_remainder(F.col("doc_id"), 10) == 0).alias("held_out"))
    training = d.where("not held_out").select("doc_id", "text")
    counts = stored(word_counts(training), "word-counts")
    trained = train(training, counts)
    out = score(d.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text"), counts, trained)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(trained.n).cast("long").alias("train_tokens"),
                      "base_score", "score")
