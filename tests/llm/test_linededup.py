import hashlib

import pytest

from recolib.llm import linededup
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row

ORDER = lambda i: (i is None, i or 0)


def brute(rows, min_docs=2, min_chars=10):
    """(doc_id, lines, lines dropped, text left) of every row, by dictionaries over whole keys."""
    lower = {c: c + 32 for c in range(65, 91)}
    holders = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            holders.setdefault(line.strip(" \t\n\x0b\x0c\r").translate(lower), set()).add(r[0])
    out = []
    for r in rows:
        lines, kept = (r[1] or "").split("\n"), []
        for line in lines:
            key = line.strip(" \t\n\x0b\x0c\r").translate(lower)
            if len(key) < min_chars or len(holders[key]) < min_docs or min(holders[key], key=ORDER) == r[0]:
                kept.append(line)
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def digests(rows):
    return sorted(((*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in linededup.line_digests(df).collect()), key=str)


def test_edge_rows_and_empty(spark):
    assert got(edge_frame(spark)) == digests(brute(edge_rows()))
    assert linededup.line_digests(empty_frame(spark)).count() == 0


def texts():
    common = "This very common LINE stands everywhere"
    out = [row(i, "\n".join([f"only in {i} " + "x" * 10, common if i % 2 else f"\t{common.lower()} \r", "short",
                             f"shared by seven {i // 7}"] * (1 + i % 3))) for i in range(300)]
    out += [row(400, "É" * 10), row(401, "é" * 10), row(402, "É" * 10), row(403, "123456789"), row(404, "123456789"),
            row(405, "1234567890 "), row(406, "  1234567890"), row(407, "1234567890"), row(408, "\n\n"),
            row(409, "手机手机手机手机手机\nA"), row(410, "a\n手机手机手机手机手机"),
            row(None, common), row(None, common + "\nnull ids hold this line"), row(None, "null ids hold this line"),
            row(500, "twice with one id"), row(500, "TWICE with one id\nand more"), row(500, "twice with one id")]
    return out


def test_hot_lines_ties_and_repeats(spark):
    rows = texts()
    want = brute(rows)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == digests(want)
    assert sum(w[2] for w in want) > 800 and any(w[3] == "" and w[2] for w in want)


@pytest.mark.parametrize("min_docs,min_chars", [(1, 3), (3, 10), (8, 0)])
def test_thresholds(spark, min_docs, min_chars):
    rows = texts()
    out = linededup.deduplicated_lines(spark.createDataFrame(rows, SCHEMA), min_docs, min_chars)
    assert sorted(((r.doc_id, *r.line_dedup) for r in out.collect()), key=str) == sorted(
        brute(rows, min_docs, min_chars), key=str)


def test_whole_rows_and_clashing_names(spark):
    d = edge_frame(spark).selectExpr("*", "1 as ROW", "2 as gone", "3 as Line_Dedup", "4 as at", "5 as h1", "6 as `a.b`")
    out = linededup.deduplicated_lines(d)
    assert out.columns == [*d.columns, "line_dedup_"]
    assert sorted(map(str, out.drop("line_dedup_").collect())) == sorted(map(str, d.collect()))


def test_hot_keys_are_few_and_their_lines_stay_put(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in d.select("doc_id", "text").collect()]
    assert got(d) == digests(brute(rows))
