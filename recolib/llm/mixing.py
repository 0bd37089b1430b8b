"""Mixing sources to target weights (operator 3).

Sizes are summed per source; each source gets a target in words, a repetition rate (target / source size), and each
document is taken floor(rate) times plus once more with probability equal to the fraction, decided by a hash of
the seed and its id. Only the per-source table is shuffled; documents get their source's rate by a join whose
small side Spark broadcasts when it is small and which AQE splits on a hot source when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recolib.llm.common import WORD, fresh_name, stored

MAX_REPEATS = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source (source, source_size): rank weights 1, 2, 3, repeating by code point with null last; targets share
    the whole by weight, none above ``MAX_REPEATS`` times its source, the excess going to the others by weight.

    Sources are capped in rounds until no target is above its cap. A round is one aggregate over the source table,
    and each round but the last caps a source, so there are few of them. Sources of size 0 get target 0."""
    by = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source, not per document
    s = stored(sizes.withColumn("weight", ((F.row_number().over(by) - 1) % 3 + 1).cast("double"))
               .withColumn("cap", MAX_REPEATS * F.col("source_size").cast("double")), "sources")
    level, capped = None, None
    while True:
        is_capped = F.lit(False) if level is None else F.col("cap") <= F.col("weight") * level
        r = s.agg(F.sum("source_size").alias("total"), F.sum(F.when(is_capped, F.col("cap"))).alias("held"),
                  F.sum(F.when(~is_capped, F.col("weight"))).alias("open"),
                  F.count(F.when(is_capped, 1)).alias("capped")).first()
        if not r.open or r.capped == capped:
            break
        level, capped = (r.total - (r.held or 0.0)) / r.open, r.capped
    target = F.lit(0.0) if level is None else F.least(F.col("cap"), F.col("weight") * F.lit(float(level)))
    return s.select("source", "source_size", target.cast("double").alias("target"))


def copies(rate: Column, doc_id: Column, seed: str) -> Column:
    """floor(rate) plus one copy with probability frac(rate), from 52 bits of md5(seed:doc_id)."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, and the copy count ``n_copies``.

    A null text has size 0; null sources form one source, last in order; a null doc_id draws as the text "null", and
    repeated rows draw alike. An empty table gives no rows. Other columns are ignored. Reruns agree: the draw depends
    on seed and id only."""
    d = docs.select("doc_id", F.col("source").cast("string").alias("source"), size_of(F.col("text")).alias("size"))
    d = stored(d, "sizes")
    t = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")))
    j = d.alias("d").join(t.alias("t"), F.expr("d.source <=> t.source"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return (j.select("doc_id", "size", "source_size", "target", copies(rate, F.col("doc_id"), seed).alias("n_copies"))
            .select("doc_id", "size", "source_size", "target", (F.col("n_copies") * F.col("size")).alias("taken"),
                    "n_copies"))


def mixed_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every column of ``docs``, each row repeated as often as it is taken (0 drops it). Rows keep
    their columns, whatever they are called: the helper columns live in one struct that is dropped again."""
    tmp = fresh_name(docs.columns, "mix")
    rated = fresh_name([*docs.columns, tmp], "rate")
    own = [F.col(f"`{c}`") for c in docs.columns]
    sized = docs.withColumn(tmp, F.struct(F.col("source").cast("string").alias("source"),
                                          size_of(F.col("text")).alias("size")))
    t = source_targets(docs.groupBy(F.col("source").cast("string").alias("source"))
                       .agg(F.sum(size_of(F.col("text"))).alias("source_size")))
    rates = t.select(F.struct("source", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                              .otherwise(F.lit(0.0)).alias("rate")).alias(rated))
    j = sized.join(rates, F.expr(f"{tmp}.source <=> {rated}.source"))
    n = copies(F.col(f"{rated}.rate"), F.col("doc_id"), seed)
    return j.select(*own, F.explode(F.array_repeat(F.lit(1), n.cast("int"))).alias(tmp)).select(*own)


SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
             {MAX_REPEATS} * source_size::DOUBLE AS cap FROM s),
r AS (SELECT *, sum(source_size) OVER () AS total,
             coalesce(sum(cap) OVER (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
             sum(weight) OVER (ORDER BY cap / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
l AS (SELECT arg_min((total - held) / open, cap / weight) FILTER (WHERE cap / weight > (total - held) / open) AS level
      FROM r),
t AS (SELECT source, source_size, least(cap, weight * coalesce(level, 1e300)) AS target FROM w, l),
m AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / {float(1 << 52)} AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS taken,
       floor(rate)::BIGINT + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS n_copies
FROM m
"""
