import re
from collections import Counter

import numpy as np
import pytest

from recolib.llm import divergence
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row


def brute(rows, min_docs=30, top=50):
    lower = {c: c + 32 for c in range(65, 91)}
    docs = [(r[2] or "", r[3] or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r[1] or "").translate(lower))))
            for r in rows]
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in d[2])
        vocab = [t for t, n in held.items() if n >= min_docs]
        sources = {d[1] for d in docs if d[0] == lang}
        count = {s: Counter() for s in sources}
        for d in docs:
            if d[0] == lang:
                count[d[1]].update({t: d[2][t] for t in vocab if t in d[2]})
        whole = sum(count.values(), Counter())

        def p(c, t):
            return 1 + 1_000_000_000 * (c[t] + 5) // (c.total() + 5 * len(vocab))

        for s in sources:
            pair = [(o, sum(abs(p(count[s], t) - p(count[o], t)) for t in vocab)) for o in sources - {s}]
            more = [(t, p(count[s], t) - p(whole, t)) for t in vocab if count[s][t] and p(count[s], t) > p(whole, t)]
            for part, found, most in (("pair", pair, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, k) for k, (item, v) in enumerate(found[:most], 1)]
    return sorted(out)


def got(df, **how):
    return sorted(tuple(r) for r in divergence.divergence(df, **how).collect())


def test_edge_rows_and_empty(spark):
    for least in (1, 2, 30):
        assert got(edge_frame(spark), min_docs=least) == brute(edge_rows(), least)
    assert divergence.divergence(empty_frame(spark)).count() == 0


def mixed(n, n_sources, n_terms):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        k = (rng.pareto(1.0, int(rng.integers(0, 40))) * 5).astype(int) % n_terms
        words = [f"Wö{chr(97 + x % 26)}{chr(97 + x // 26 % 26)}" for x in k]
        s = 0 if i % 3 == 0 else int(rng.integers(0, n_sources))
        rows.append(row(i, ", ".join(words), ["en", "de", None][i % 5 % 3], None if s == 1 else f"s{s}"))
    return rows


def test_hot_source_and_ties(spark):
    rows = mixed(900, 7, 300)
    want = brute(rows, 5)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4), min_docs=5) == want
    assert any(r[4] == 0 for r in brute(edge_rows())) and len(want) > 300


@pytest.mark.parametrize("block_terms,block_sources", [(16, 4), (1, 1)])
def test_many_blocks(spark, monkeypatch, block_terms, block_sources):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", block_sources)
    monkeypatch.setattr(divergence, "FLUSH_TERMS", 50)
    rows = mixed(400, 11, 60)
    assert got(spark.createDataFrame(rows, SCHEMA), min_docs=5) == brute(rows, 5)


def test_runs_and_shares():
    rng = np.random.default_rng(1)
    counts = np.minimum(rng.geometric(0.5, (500, 6)) - 1, 4)
    order = divergence.clustered(counts)
    assert sorted(order) == list(range(500))
    n_runs = lambda m: sum(len(divergence.runs(c)[0]) for c in m.T)
    assert n_runs(counts[order]) < 0.8 * n_runs(counts)
    a, b = (divergence.runs(counts[order][:, k]) for k in (0, 5))
    assert divergence.pair_sum(a, b, 500) == np.abs(counts[:, 0] - counts[:, 5]).sum()
    assert divergence.pair_sum(divergence.runs(counts[:0, 0]), divergence.runs(counts[:0, 1]), 0) == 0
    for total in (1, 7, 10**9 + 7, 9 * 10**15):
        c = np.array([0, 1, total // 3, total])
        assert divergence.share(c, total).tolist() == [1 + 10**9 * int(x) // total for x in c]


def test_large_counts_on_columns(spark):
    from pyspark.sql import functions as F
    rows = [(0, 0, 1), (10**14, 3 * 10**14, 10**9), (10**9 * 12, 10**13 + 1, 77)]
    d = spark.createDataFrame(rows, "c long, n long, v long")
    out = [r[0] for r in d.select(divergence.share_column(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert out == [1 + 10**9 * (c + 5) // (n + 5 * v) for c, n, v in rows]
