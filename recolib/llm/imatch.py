"""Document fingerprints (operator 6): I-Match over randomised lexicons, in built-in functions only.

Terms are lower-cased runs of letters and digits, hashed. Document frequency is counted per cell of ``CELLS`` hash
cells over all documents; the lexicon is the set of cells in the chosen inverse-document-frequency band, held as a
bit array of fixed size (CELLS bits, 128 KB) whatever the corpus, which reaches the tasks as a constant of the plan. A document's
distinct lexicon terms are sorted and hashed once per random lexicon subset. Subsets come in four densities
(1/16 to 1/1024 of the lexicon), so short and long documents both have some that an edit leaves alone.

The next document comes from a window within ranges of doc_id; the first row of the following range is added to each
range as a halo, so no task sees more than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolib.llm.common import text_or_empty

CELL_BITS = 20
CELLS = 1 << CELL_BITS
MIN_IDF, MAX_IDF = 2.0, 8.0  # ln(documents / document frequency)
DENSITIES = ((16, 0), (64, 8), (256, 16), (1024, 24))  # one of so many parts, by hash bits from there
SUBSETS = 8  # of each density
ROWS_PER_RANGE, MAX_RANGES = 1000, 16_384
FINGERPRINT = "array<int>"


def terms(text: Column) -> Column:
    """Sorted distinct term hashes of a text; empty for a text without letters and digits."""
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.array_sort(F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))))


def _cell(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - CELL_BITS).cast("int")


def lexicon(texts: DataFrame, min_idf: float = MIN_IDF, max_idf: float = MAX_IDF) -> Column:
    """The cells in the band as a literal of CELLS / 64 longs, a bit per cell, from all rows' ``text``. Its size is
    fixed; frequencies are summed per cell, so rare terms of one cell count together."""
    n = texts.count()
    cells = texts.select(F.explode(F.array_distinct(F.transform(terms(F.col("text")), _cell))).alias("cell"))
    idf = F.log(F.lit(float(max(n, 1))) / F.col("count"))
    words = (cells.groupBy("cell").count().where(idf.between(min_idf, max_idf))
             .groupBy(F.shiftright("cell", 6).alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(63))).alias("word")))
    bits = [0] * (CELLS // 64)
    for r in words.collect():
        bits[r["at"]] = r["word"]
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def fingerprint(text: Column, bits: Column) -> Column:
    """``array<int>`` with a hash per lexicon subset, null where the document has no term of that subset. A document
    without any lexicon term uses all its terms instead."""
    def subsets(own: Column) -> Column:
        return F.concat(*[hashes(own, parts, shift) for parts, shift in DENSITIES])

    def hashes(own: Column, parts: int, shift: int) -> Column:
        def part(h: Column) -> Column:
            return F.shiftright(h, shift).bitwiseAND(parts - 1)

        def one(kept: Column, j: int) -> Column:
            return _let(F.filter(kept, lambda h: part(h) == j),
                        lambda s: F.when(F.size(s) > 0, F.xxhash64(s).bitwiseAND(0x7FFFFFFF).cast("int")))

        return _let(F.filter(own, lambda h: part(h) < SUBSETS),
                    lambda kept: F.array(*[one(kept, j) for j in range(SUBSETS)]))

    def known(h: Column) -> Column:
        cell = _cell(h)
        return F.getbit(F.get(bits, F.shiftright(cell, 6)), cell.bitwiseAND(63)) == 1

    def choose(all_terms: Column) -> Column:
        return _let(F.filter(all_terms, known), lambda own: F.when(F.size(own) > 0, own).otherwise(all_terms))

    return _let(_let(terms(text), choose), subsets).cast(FINGERPRINT)


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets with terms of either side whose hashes agree; 1 or 0 by equality when there is none."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y)))
    return _let(F.filter(same, lambda x: x.isNotNull()), lambda s: F.when(
        F.size(s) > 0, F.size(F.filter(s, lambda x: x)) / F.size(s)).otherwise(a.eqNullSafe(b).cast("double")))


def as_text(fp: Column) -> Column:
    """Eight hex digits per subset, ``-`` for a subset without terms."""
    return F.array_join(F.transform(fp, lambda h: F.when(h.isNull(), "-").otherwise(
        F.lpad(F.lower(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF))), 8, "0"))), "")


def _ranges(docs: DataFrame, rows: int) -> list[int]:
    n = min(MAX_RANGES, rows // ROWS_PER_RANGE)
    if n < 2:
        return []
    cuts = docs.where("doc_id is not null").approxQuantile("doc_id", [k / n for k in range(1, n)], 0.25 / n)
    return sorted({int(c) for c in cuts})


def _range_of(doc_id: Column, cuts: list[int]) -> Column:
    """Range number of an id, ascending: how many cuts are at most the id; found in two steps of about sqrt(n) tests.
    Null ids form the range below all others."""
    if not cuts:
        return F.when(doc_id.isNull(), -1).otherwise(0)
    step = max(1, int(len(cuts) ** 0.5))
    coarse = cuts[::step]
    block = F.size(F.filter(F.lit(coarse), lambda c: c <= doc_id))
    fine = F.get(F.lit([cuts[k:k + step] + [2 ** 63 - 1] * (step - len(cuts[k:k + step])) for k in range(0, len(cuts), step)]),
                 block - 1)
    return F.when(doc_id.isNull(), -1).when(block == 0, 0).otherwise(
        (block - 1) * step + F.size(F.filter(fine, lambda c: c <= doc_id)))


def with_next(d: DataFrame, carried: list[str]) -> DataFrame:
    """``d`` with ``next_<c>`` of the next row by descending (doc_id, tie) for each carried column; after the last
    row comes the first. Null ids come last; ``tie`` orders rows of one id, and rows equal in both are alike."""
    cuts = _ranges(d.select("doc_id"), d.count())
    d = d.withColumn("range", _range_of(F.col("doc_id"), cuts))
    heads = sorted(d.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("head")).collect(),
                   key=lambda r: -r["range"])
    if not heads:
        return d.select(*[c for c in d.columns if c != "range"], *[F.col(c).alias(f"next_{c}") for c in carried])
    # the head of each range also stands behind the last row of the range before it
    halo = [(h["head"]["doc_id"], h["head"]["tie"], heads[k - 1]["range"]) for k, h in enumerate(heads)]
    small = d.sparkSession.createDataFrame(halo, "h_id long, h_tie long, h_range int")
    extra = (d.join(F.broadcast(small), F.expr("doc_id <=> h_id and tie = h_tie"))
             .dropDuplicates(["doc_id", "tie", "h_range"])
             .withColumn("range", F.col("h_range")).drop("h_id", "h_tie", "h_range").withColumn("halo", F.lit(True)))
    w = Window.partitionBy("range").orderBy("halo", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    both = d.withColumn("halo", F.lit(False)).unionByName(extra)
    return (both.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
            .where(~F.col("halo")).drop("halo", "range"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A null text counts as empty; its fingerprint has no terms and equals that of any other text without terms. Rows of
    one doc_id follow each other by a hash of their text; null ids come last; a single row is its own next document.
    An empty table gives no rows. Other columns are ignored."""
    d = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    bits = lexicon(d.select("text"))
    d = d.withColumn("tie", F.xxhash64("text")).withColumn("fp", fingerprint(F.col("text"), bits))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    d = with_next(d, ["text", "fp"]).withColumn(
        "edited", F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third)))
    d = d.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "fp", "next_fp",
                 fingerprint(F.col("edited"), bits).alias("edited_fp"))
    return d.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                    as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                    likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                    likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))
