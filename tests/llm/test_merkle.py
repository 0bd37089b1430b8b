import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from recolib.llm import merkle
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, text):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[3], r[2], r[4], text)])


def tree(nodes):
    """All levels of one tree, lowest first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([H(*below[i:i + 16]) for i in range(0, len(below), 16)])
    return levels


def path(levels, at):
    """(digests before, digests after) of node ``at`` in its run, level by level."""
    out = []
    for level in levels[:-1]:
        run, k = level[at // 16 * 16:at // 16 * 16 + 16], at % 16
        out.append((run[:k], run[k + 1:]))
        at //= 16
    return out


def brute(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees, order = {}, {}
    for s in sources:
        own = sorted((r for r in rows if r[3] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        order[s], trees[s] = own, tree([leaf(r, r[1]) for r in own])
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for at, r in enumerate(order[s]):
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            h, steps = leaf(r, text), path(trees[s], at) + path(top, i)
            for before, after in steps:
                h = H(*before, h, *after)
            out.append((r[0], leaf(r, r[1]), trees[s][-1][0], top[-1][0], H(*[x for b, a in steps for x in b + a]), h,
                        h == top[-1][0]))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=str)


def test_edge_rows_and_empty(spark):
    assert got(edge_frame(spark)) == brute(edge_rows())
    assert merkle.audit(empty_frame(spark)).count() == 0


@pytest.mark.parametrize("sizes", [[1], [16], [17], [2, 256, 257], [1] * 20 + [300, 15]])
def test_tree_shapes(spark, sizes):
    rows = [row(1000 * s + i, f"Text {i}", source=None if s == 0 else f"é{s}" if s % 2 else f"z{s}")
            for s, n in enumerate(sizes) for i in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_three_kept_levels_with_a_hot_source_and_many_sources(spark):
    d = spark.range(70_000).select(
        F.when(F.col("id") % 1000 != 7, F.col("id")).alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"),
        F.lit("en").alias("lang"),
        F.when(F.col("id") < 66_000, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id") % 300)).alias("source"),
        F.lit(None).cast("long").alias("n_chars"))
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in d.collect()]
    assert got(d) == brute(rows)


def test_repeated_rows(spark):
    rows = [row(7, "Same Row") for _ in range(400)] + [row(None, "no id") for _ in range(40)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_a_proof_convicts_only_what_changed(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in d.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    out = got(d)
    assert out == brute(rows)
    changed = {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in r[1])}
    assert {r[0] for r in out if not r[6]} == changed and changed
