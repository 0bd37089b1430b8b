"""Source divergence audit (operator 11): run-length columns over a reordered vocabulary.

1. Terms are counted per (lang, source, term) in Python batches, with the number of documents, and added up by a
   map-side combined aggregate. A language's vocabulary is the terms in ``MIN_DOCS`` of its documents or more.
2. The vocabulary is cut into blocks in which equal totals lie together (a frequent total is cut by term hash), so that
   a block's terms have few different counts; its size does not grow with the corpus, only the number of blocks does.
   The sources of a language with many of them are cut into blocks too; a task takes two such blocks.
3. In a task every source is a column of counts. The terms are put in an order that clusters equal counts, each column
   is run-length encoded and its runs' shares are computed. For a pair the boundaries of both columns' runs are
   intersected, and each common run adds |p - q| times its length.
4. A pair's sums over the vocabulary blocks are added; ranks are window functions with a limit below the shuffle.

All arithmetic is on integers: ``share`` divides in three steps of a thousand, which stays in 64 bits for up to
9 * 10^15 occurrences a group.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolib.llm.common import ASCII_LOWER, stored

MIN_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
BLOCK_TERMS = 2048
BLOCK_SOURCES = 128
FLUSH_TERMS = 500_000  # counts that a counting task holds before it passes them on

# A-Z become a-z, every other ASCII character but a-z becomes a space; bytes of other characters stay
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in ASCII_LOWER)


def terms(text: str) -> list[bytes]:
    """Terms of a whole text in order, as UTF-8."""
    return text.encode().translate(_FOLD).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that hold the term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, of_docs) in groups.items():
                yield pa.record_batch({"lang": pa.array([lang] * len(n), pa.string()),
                                       "source": pa.array([source] * len(n), pa.string()),
                                       "term": pa.array(list(n), pa.binary()).cast(pa.string()),
                                       "n": pa.array(list(n.values()), pa.int64()),
                                       "docs": pa.array([of_docs[t] for t in n], pa.int64())})

        for batch in batches:
            for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source"))):
                n, of_docs = groups.setdefault((lang, source), (Counter(), Counter()))
                words = terms(text)
                held -= len(n)
                n.update(words)
                of_docs.update(set(words))
                held += len(n)
                if held >= FLUSH_TERMS:
                    yield from flush()
                    groups.clear()
                    held = 0
        yield from flush()

    counted = docs.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * count / total) for 0 <= count <= total, by long division in base 1000."""
    out, rest = np.zeros(len(count), np.int64), np.asarray(count, np.int64)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        out = out * 1000 + step
    return out + 1


def share_column(count: Column, n: Column, terms: Column) -> Column:
    """The same on columns: of a count, its group's sum and the size of the vocabulary."""
    whole = (F.lit(SCALE).cast("decimal(10,0)") * (count + SMOOTHING).cast("decimal(19,0)")).alias("whole")
    return F.call_function("div", whole, (n + SMOOTHING * terms).cast("decimal(19,0)")) + 1


def clustered(counts: np.ndarray) -> np.ndarray:
    """An order of the rows (terms) of a terms x sources matrix that clusters equal counts: sorted by the columns,
    those with the fewest different values first, so that the leading columns have one run per value."""
    different = [len(np.unique(c)) for c in counts.T]
    return np.lexsort(counts.T[np.argsort(different, kind="stable")[::-1]])


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and values of a column's runs."""
    start = np.flatnonzero(np.concatenate([[True], column[1:] != column[:-1]])) if len(column) else np.empty(0, int)
    return start, column[start]


def pair_sum(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], length: int) -> int:
    """Sum of |p - q| over all rows of two run-length encoded columns of shares."""
    if not length:
        return 0
    cut = np.union1d(a[0], b[0])
    p, q = (v[np.searchsorted(s, cut, "right") - 1] for s, v in (a, b))
    return int((np.abs(p - q) * np.diff(cut, append=length)).sum())


def _blocks(size: Column, block: int) -> Column:
    return F.greatest(F.ceil(size / block), F.lit(1).cast("long"))


def with_blocks(vocabulary: DataFrame) -> DataFrame:
    """(lang, term, total) with ``n_terms`` of the language and the term's ``block``. Terms of one total go together;
    more than ``BLOCK_TERMS`` of them go by term hash."""
    n_terms = vocabulary.groupBy("lang").agg(F.count("*").alias("n_terms"))
    levels = vocabulary.groupBy("lang", "total").agg(F.count("*").alias("n_equal"))
    part = F.pmod(F.xxhash64("term", F.lit("part")), _blocks(F.col("n_equal"), BLOCK_TERMS))
    block = F.pmod(F.xxhash64("total", part), _blocks(F.col("n_terms"), BLOCK_TERMS))
    return (vocabulary.join(levels, ["lang", "total"]).join(n_terms, "lang")
            .select("lang", "term", "total", "n_terms", block.alias("block")))


def _pair_rows(table: pa.Table) -> pa.Table:
    """Partial sums of one task: the pairs of the sources of its two source blocks over one block of terms. Rows
    without a term stand for the sources themselves, so that every pair occurs even where there is no count; their
    ``n`` is the number of terms of the block."""
    key = {c: table.column(c)[0].as_py() for c in ("lang", "left", "right")}
    pdf = table.select(["source", "side", "n_total", "n_terms", "term", "n"]).to_pandas()
    heads = pdf[pdf["term"].isna()]
    column = {s: i for i, s in enumerate(heads["source"])}
    entries, size = pdf[pdf["term"].notna()], int(heads["n"].iloc[0])
    counts = np.zeros((size, len(column)), np.int64)  # terms that other sources hold are rows of zeros
    counts[pd.factorize(entries["term"])[0], entries["source"].map(column).to_numpy(np.int64)] = entries["n"]
    counts = counts[clustered(counts)]
    encoded = []
    for i, (n_total, n_terms) in enumerate(zip(heads["n_total"], heads["n_terms"])):
        start, value = runs(counts[:, i])
        total = int(n_total) + SMOOTHING * int(n_terms)
        encoded.append((start, share(value + SMOOTHING, total) if size else value))
    names, sides = heads["source"].tolist(), heads["side"].tolist()
    # a pair has the same order in every block of terms
    if key["left"] == key["right"]:
        order = sorted(range(len(names)), key=names.__getitem__)
        pairs = [(i, j) for at, j in enumerate(order) for i in order[:at]]
    else:
        sets = [[i for i, s in enumerate(sides) if s == block] for block in (key["left"], key["right"])]
        pairs = [(i, j) for i in sets[0] for j in sets[1]]
    values = [pair_sum(encoded[i], encoded[j], size) for i, j in pairs]
    return pa.table({"lang": pa.array([key["lang"]] * len(pairs), pa.string()),
                     "a": pa.array([names[i] for i, _ in pairs], pa.string()),
                     "b": pa.array([names[j] for _, j in pairs], pa.string()),
                     "value": pa.array(values, pa.int64())})


def pair_values(kept: DataFrame, groups: DataFrame, blocks: DataFrame) -> DataFrame:
    """(lang, a, b, value) of every two sources of a language, each pair once: the sum of |p - q| over the vocabulary.

    ``kept``: (lang, source, term, n, block) of terms in the vocabulary; ``groups``: (lang, source, n_total, n_terms,
    n_sources); ``blocks``: (lang, block, size). A language without vocabulary has one block of no terms."""
    heads = groups.withColumn("n_sides", _blocks(F.col("n_sources"), BLOCK_SOURCES)).withColumn(
        "side", F.pmod(F.xxhash64("source"), F.col("n_sides")))
    columns = ["lang", "block", "source", "side", "n_sides", "n_total", "n_terms", "term", "n"]
    entries = kept.join(heads, ["lang", "source"]).select(*columns)
    none = F.lit(0).cast("long")
    every = (heads.join(blocks, "lang", "left").withColumn("block", F.coalesce("block", none))
             .withColumn("term", F.lit(None).cast("string")).withColumn("n", F.coalesce("size", none)).select(*columns))
    other = F.explode(F.sequence(none, F.col("n_sides") - 1)).alias("other")
    dealt = (entries.unionByName(every).select("*", other).drop("n_sides")
             .withColumn("left", F.least("side", "other")).withColumn("right", F.greatest("side", "other")).drop("other"))
    sums = dealt.groupBy("lang", "block", "left", "right").applyInArrow(
        _pair_rows, "lang string, a string, b string, value long")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from each other one (part ``pair``)
    and which terms it uses more than the language does (part ``term``, the first ``top_terms``).

    Null text, lang and source are empty strings. A row is a document, whatever its id; repeated rows count repeatedly.
    A group without terms and a language without vocabulary have pairs (value 0 in the latter) and no terms. Equal
    values rank by the item's UTF-8 bytes. An empty table gives no rows; other columns are ignored."""
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stored(term_counts(d), "terms")
    vocabulary = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_docs).drop("docs")
    vocabulary = stored(with_blocks(stored(vocabulary, "vocabulary")), "blocks")
    kept = stored(counts.join(vocabulary, ["lang", "term"])
                  .select("lang", "source", "term", "n", "total", "block"), "kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_total"))
    langs = vocabulary.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("n_terms").alias("n_terms"))
    seen = d.select("lang", "source").distinct()
    n_sources = seen.groupBy("lang").agg(F.count("*").alias("n_sources"))
    groups = stored(seen.join(n_sources, "lang").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
                    .na.fill(0, ["n_total", "lang_total", "n_terms"]), "groups")

    blocks = vocabulary.groupBy("lang", "block").agg(F.count("*").alias("size"))
    pairs = pair_values(kept, groups, blocks)
    both = pairs.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), "value"),
                                                 F.struct(F.col("b").alias("source"), F.col("a").alias("item"), "value"))))
    used = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share_column(F.col("n"), F.col("n_total"), F.col("n_terms")).alias("p"),
        share_column(F.col("total"), F.col("lang_total"), F.col("n_terms")).alias("q"))
    more = used.where("p > q").select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))
    return _ranked(both, "pair").unionByName(_ranked(more, "term").where(F.col("rank") <= top_terms))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS uid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
t AS (SELECT uid, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term, count(*) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT uid) >= {MIN_DOCS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n_total FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
l AS (SELECT lang, count(*) AS n_terms, sum(total) AS lang_total FROM v GROUP BY lang),
p AS (SELECT s.lang, s.source, v.term, coalesce(c.n, 0) AS n,
             1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + {SMOOTHING})) // (n_total + {SMOOTHING} * n_terms) AS p,
             1 + ({SCALE}::HUGEINT * (v.total + {SMOOTHING})) // (lang_total + {SMOOTHING} * n_terms) AS q
      FROM s JOIN l USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = v.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
x AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM x)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
