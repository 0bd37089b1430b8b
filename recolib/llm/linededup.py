"""Line dedup (operator 13): lines that several documents hold stay only in the first document that holds them.

1. Every row gets a number, and rows and numbers are written once, so later steps name a row without its text.
2. Lines are normalised and exploded as (row, document, position, 128-bit hash of the key).
3. Per hash, one map-side combined aggregate gives the number of documents and the smallest one. Being held by two
   documents is ``min != max``; only higher thresholds need a distinct count.
4. Lines meet their hash's verdict in a join. A key that holds more than 1 / ``HOT_SHARE`` of all lines is hot; there
   are fewer than ``HOT_SHARE`` such keys whatever the input, so they are broadcast and their lines never shuffled.
5. Dropped positions are gathered per row and joined with the written rows, whose texts are put together again from
   the positions that are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recolib.llm.common import fresh_name, let, stored, text_or_empty

MIN_DOCS = 2
MIN_CHARS = 10
HOT_SHARE = 1024
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """Lines of a text; a null or empty text has one empty line."""
    return F.split(text_or_empty(text), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, LOWER)


def _document(doc_id: Column) -> Column:
    """Documents in order: ids ascending, the null id last."""
    return F.struct(doc_id.isNull().alias("no_id"), doc_id.cast("long").alias("id"))


def _verdicts(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first, n): keys held by ``min_docs`` documents or more, their first document and number of lines."""
    count = F.count("*").alias("n")
    if min_docs <= 2:
        held = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), count)
        return held.where("first != last" if min_docs == 2 else "true").drop("last")
    held = lines.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.count_distinct("doc").alias("docs"), count)
    return held.where(F.col("docs") >= min_docs).drop("docs")


def deduplicated_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                       result: str = "line_dedup") -> DataFrame:
    """Every row of ``docs`` with all its columns and a struct ``result``: ``n_lines`` and ``n_dropped`` (long) and
    ``text``, the lines left, joined by newlines. Keys of ``min_chars`` code points or more held by ``min_docs``
    documents or more lose their lines everywhere but in the smallest doc_id holding them, where all stay.

    A null or empty text is one empty line. Rows of one doc_id are one document: a line that only they share stays in
    all of them. A null doc_id is one document, after all others. Repeated rows each give a row; an empty table gives
    none. Columns may have any name; ``result`` grows underscores while it is one of them."""
    row, found = fresh_name(docs.columns, "row"), fresh_name(docs.columns, result)
    gone = fresh_name([*docs.columns, row], "gone")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")

    keys = F.transform(lines_of(F.col("text")), lambda x, i: F.struct(i.alias("at"), line_key(x).alias("key")))
    long_keys = F.filter(keys, lambda k: F.char_length(k["key"]) >= min_chars)
    hashed = F.transform(long_keys, lambda k: F.struct(
        k["at"].alias("at"), F.xxhash64(k["key"]).alias("h1"), F.xxhash64(F.lit("line"), k["key"]).alias("h2")))
    lines = rows.select(F.col(row).alias("row"), _document(F.col("doc_id")).alias("doc"), F.inline(hashed))
    lines = stored(lines, "lines")

    verdicts = stored(_verdicts(lines, min_docs), "verdicts")
    hot_lines = lines.count() // HOT_SHARE
    hot = F.broadcast(verdicts.where(F.col("n") > hot_lines))  # fewer than HOT_SHARE keys
    of_hot = lines.join(hot, ["h1", "h2"])
    of_rest = lines.join(hot.select("h1", "h2"), ["h1", "h2"], "left_anti").join(
        verdicts.where(F.col("n") <= hot_lines), ["h1", "h2"])
    dropped = (of_hot.unionByName(of_rest).where("doc != first").groupBy(F.col("row").alias(row))
               .agg(F.collect_list("at").alias(gone)))

    def kept_text(split: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
        return F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")

    split = lines_of(F.col("text"))
    kept = F.when(F.col(gone).isNull(), text_or_empty(F.col("text"))).otherwise(let(split, kept_text))
    verdict = F.struct(F.size(split).cast("long").alias("n_lines"),
                       F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"), kept.alias("text"))
    return rows.join(dropped, row, "left").select(*[F.col(f"`{c}`") for c in docs.columns], verdict.alias(found))


def line_digests(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_dropped, kept_sha256, as ``deduplicated_lines`` decides; other columns
    are ignored."""
    d = deduplicated_lines(docs.select("doc_id", "text"), result="r")
    return d.select("doc_id", "r.n_lines", "r.n_dropped", F.sha2(F.col("r.text"), 256).alias("kept_sha256"))


_KEY = (f"translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}')")
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
x AS (SELECT uid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, {_KEY} AS key FROM x),
f AS (SELECT key, min(coalesce(doc_id, 9223372036854775807::HUGEINT + 1)) AS first FROM k WHERE length(key) >= {MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT coalesce(doc_id, 9223372036854775807::HUGEINT + 1)) >= {MIN_DOCS}),
m AS (SELECT k.*, f.key IS NOT NULL AND f.first <> coalesce(doc_id, 9223372036854775807::HUGEINT + 1) AS dropped
      FROM k LEFT JOIN f ON k.key = f.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY uid
"""
