import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from recolib.llm import anchors, substrings
from recolib.llm.queries import op7_repeated_substrings
from recolib.llm.suffix import suffix_orders
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row

SF = "/root/testdata/sf0.001"
K = anchors.LENGTH


def brute(rows):
    data = [(r[1] or "").encode() for r in rows]
    seen = Counter(d[i:i + K] for d in data for i in range(len(d) - K + 1))
    out = []
    for r, d in zip(rows, data):
        gone = bytearray(len(d))
        for i in range(len(d) - K + 1):
            if seen[d[i:i + K]] > 1:
                gone[i:i + K] = b"\1" * K
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=1, max_size=25), min_size=1, max_size=8))
def test_suffix_orders(strings):
    symbols = np.array([x for s in strings for x in s])
    start = np.cumsum([0] + [len(s) for s in strings])
    order = suffix_orders(symbols, start)
    for k, s in enumerate(strings):
        want = sorted(range(len(s)), key=lambda i: s[i:])
        assert (order[start[k]:start[k + 1]] - start[k]).tolist() == want


def test_equal_strings_have_equal_anchors():
    r = np.random.default_rng(0)
    text = r.integers(0, 3, 3000).astype(np.uint8)
    text[1000:1400] = text[200:600]
    text[2000:2500] = np.tile(text[:5], 100)
    key, at, low, high = anchors.anchors(text)
    assert low[0] == 0 and high[-1] == len(text) - K and (low[1:] == high[:-1] + 1).all()
    of = {}
    for k, a, lo, hi in zip(key, at, low, high):
        for p in range(lo, hi + 1):
            assert p <= a <= p + K - anchors.GRAM
            assert of.setdefault(text[p:p + K].tobytes(), (k, a - p)) == (k, a - p)


def test_documents_by_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op7_repeated_substrings(spark, SF)) == brute(rows)


def planted():
    r = random.Random(9)
    make = lambda n: "".join(r.choices("abcdé ", k=n))
    passages = [make(n) for n in (150, 180, 199, 200, 201, 240, 700, 2500)]
    rows = []
    for i in range(60):
        parts = [make(r.randint(0, 150))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            parts += [p[a:a + r.randint(100, 900)], make(r.randint(0, 120))]
        rows.append(row(i, "".join(parts)))
    rows += [row(100, "ab" * 400), row(101, "ba" * 90), row(102, "x" * 199), row(103, "x" * 200), row(104, "x" * 201),
             row(105, rows[3][1]), row(106, "q" + "z" * 205 + "q"), row(107, make(50) + rows[5][1][:-1])]
    return rows


def test_planted_passages(spark, monkeypatch):
    rows = planted()
    want = brute(rows)
    d = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(substrings.without_repeats(d)) == want
    kept = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in substrings.kept_bytes(d).collect()}
    assert kept == {w[0]: w[4] for w in want}
    monkeypatch.setattr(substrings, "FILTER_BITS", 64)  # every anchor passes
    monkeypatch.setattr(substrings, "GROUP_ROWS", 3)
    monkeypatch.setattr(substrings, "MAX_SENT", 2)
    assert got(substrings.without_repeats(d)) == want


def test_common_short_passage_is_not_gathered_in_one_group(spark, monkeypatch):
    r = random.Random(2)
    make = lambda n: "".join(r.choices("abcdefgh ", k=n))
    rows = []
    for k, n in enumerate((100, 150, 190, 199)):
        common = make(n)
        rows += [row(100 * k + i, make(250) + common + make(250)) for i in range(30)]
        rows += [row(100 * k + 50 + i, make(40) + rows[-1 - i][1][200:480]) for i in range(3)]  # some strings do repeat
    want = brute(rows)
    assert sum(w[2] > 0 for w in want) >= 12
    d = spark.createDataFrame(rows, SCHEMA).repartition(4)
    monkeypatch.setattr(substrings, "GROUP_ROWS", 10)
    assert got(substrings.without_repeats(d)) == want
    texts = d.selectExpr("doc_id", "xxhash64(text) as h", "text")
    seen = substrings.occurrences(texts, substrings.repeated_anchors(texts.select("text"))).cache()
    usual, large = substrings._contexts(seen)
    assert max(x["count"] for x in usual.groupBy("key").count().collect()) <= 10
    assert usual.count() + large.count() == seen.select("key", "c").distinct().count() and large.count() >= 60


def test_edge_rows_and_empty(spark):
    assert got(substrings.without_repeats(edge_frame(spark))) == brute(edge_rows())
    assert substrings.without_repeats(empty_frame(spark)).count() == 0
