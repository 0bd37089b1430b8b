import hashlib
import re

import pytest

from recolib.llm import mixing
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0d]+", r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for r, n in zip(rows, size) if r[3] == s) for s in sources}
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    target, rest = {}, set(sources)
    while rest:
        level = (sum(total.values()) - sum(target.values())) / sum(weight[s] for s in rest)
        over = {s for s in rest if weight[s] * level >= 3 * total[s]}
        target |= {s: 3 * total[s] for s in over} if over else {s: weight[s] * level for s in rest}
        rest = rest - over if over else set()
    out = []
    for r, n in zip(rows, size):
        rate = target[r[3]] / total[r[3]] if total[r[3]] else 0
        key = f"{mixing.SEED}:{'null' if r[0] is None else r[0]}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2 ** 52
        out.append((r[0], n, total[r[3]], target[r[3]], (int(rate) + (u < rate % 1)) * n))
    return out


def check(got, want):
    got, want = sorted(got, key=str), sorted(want, key=str)
    assert [(*g[:3], g[4]) for g in got] == [(*w[:3], w[4]) for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want])


def test_edge_rows(spark):
    got = mixing.mix(edge_frame(spark)).select("doc_id", "size", "source_size", "target", "taken").collect()
    check([tuple(r) for r in got], brute(edge_rows()))


def test_capped_targets_and_hot_source(spark):
    rows = [row(i, "w " * (i % 7 + 1), source="s0" if i < 300 else f"s{i % 6}") for i in range(600)]
    rows += [row(1000 + i, "w", source=f"t{i}") for i in range(4)] + [row(2000, "", source="empty")]
    want = brute(rows)
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "size", "source_size", "target", "taken")
    check([tuple(r) for r in got.collect()], want)
    assert all(w[3] <= 3 * w[2] + 1e-9 and w[4] <= 3 * w[1] for w in want)


def test_empty_and_rerun(spark):
    assert mixing.mix(empty_frame(spark)).count() == 0
    assert mixing.mixed_documents(empty_frame(spark)).count() == 0
    a, b = (sorted(map(str, mixing.mix(edge_frame(spark, n)).collect())) for n in (2, 5))
    assert a == b


def test_repeats_match_the_counts(spark):
    rows = [row(i, "w " * (i % 5), source=f"s{i % 4}") for i in range(200)]
    d = spark.createDataFrame(rows, SCHEMA)
    mixed = mixing.mixed_documents(d)
    assert mixed.columns == d.columns
    n = {r[0]: r[1] for r in mixed.groupBy("doc_id").count().collect()}
    want = {r.doc_id: r.n_copies for r in mixing.mix(d).collect() if r.n_copies}
    assert n == want
