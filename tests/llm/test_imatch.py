import hashlib
import math
import re
import struct
from collections import Counter

import regex
import xxhash
from pyspark.sql import functions as F

from recolib.llm import imatch
from recolib.llm.queries import op6_fingerprints
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row

SF = "/root/testdata/sf0.001"


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def terms(text):
    return sorted({signed(xxhash.xxh64(w.encode(), seed=42).intdigest()) for w in regex.findall(r"[\p{L}\p{N}]+", text.lower())})


def cell(h):
    return (h & (2 ** 64 - 1)) >> (64 - imatch.CELL_BITS)


def lexicon(texts):
    df = Counter(c for t in texts for c in {cell(h) for h in terms(t)})
    return {c for c, n in df.items() if imatch.MIN_IDF <= math.log(len(texts) / n) <= imatch.MAX_IDF}


def fingerprint(text, lex):
    every = terms(text)
    own = [h for h in every if cell(h) in lex] or every
    out = []
    for parts, shift in imatch.DENSITIES:
        for j in range(imatch.SUBSETS):
            s = [h for h in own if (h >> shift) % parts == j]
            x = 42
            for h in s:
                x = xxhash.xxh64(struct.pack("<q", h), seed=x).intdigest()
            out.append(x & 0x7FFFFFFF if s else None)
    return out


def likeness(a, b):
    either = [(x, y) for x, y in zip(a, b) if x is not None or y is not None]
    return sum(x == y for x, y in either) / len(either) if either else float(a == b)


def as_text(fp):
    return "".join("-" if h is None else f"{h:08x}" for h in fp)


def brute(rows):
    texts = [r[1] or "" for r in rows]
    lex = lexicon(texts)
    tie = [signed(xxhash.xxh64(t.encode(), seed=42).intdigest()) for t in texts]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, tie[i]), reverse=True)
    out = []
    for k, i in enumerate(order):
        nxt = texts[order[(k + 1) % len(order)]]
        n = len(texts[i])
        edited = texts[i][:n - n // 3] + nxt[:n // 3]
        fp, efp, nfp = (fingerprint(t, lex) for t in (texts[i], edited, nxt))
        out.append((rows[i][0], n, hashlib.sha256(edited.encode()).hexdigest(), as_text(fp), as_text(efp),
                    round(likeness(fp, efp), 9), round(likeness(fp, nfp), 9)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:5] + (round(r[5], 9), round(r[6], 9)) for r in df.collect()), key=str)


def test_edge_rows(spark):
    assert rows_of(imatch.fingerprints(edge_frame(spark))) == brute(edge_rows())


def test_documents_in_many_ranges(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(docs)
    for rows in (1000, 7):
        monkeypatch.setattr(imatch, "ROWS_PER_RANGE", rows)
        assert rows_of(op6_fingerprints(spark, SF)) == want
    near = [r[5] for r in want], [r[6] for r in want]
    assert sum(near[0]) > 5 * sum(near[1])
    fps = {}
    for (_, text), r in zip(sorted(docs), sorted(want, key=lambda r: r[0])):
        assert fps.setdefault(text, r[3]) == r[3]


def test_empty_and_single(spark):
    assert imatch.fingerprints(empty_frame(spark)).count() == 0
    one = [row(7, "a single document of words")]
    assert rows_of(imatch.fingerprints(spark.createDataFrame(one, SCHEMA))) == brute(one)


def test_plan_is_native_and_windows_stay_in_ranges(spark):
    plan = op6_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|SinglePartition|Cartesian|NestedLoop", plan)
