import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from recolib.llm import quality
from recolib.llm.queries import op5_quality_rules
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame, row

SF = "/root/testdata/sf0.01"


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def entropy(p):
    return -sum(x * math.log2(x) for x in p if x)


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return math.sqrt(max(0, entropy(m) - (entropy(p) + entropy(q)) / 2))


def test_counts_of_edge_rows(spark):
    got = sorted((tuple(r)[:7] for r in quality.quality(edge_frame(spark)).collect()), key=str)
    assert got == sorted(((r[0], *base(r[1])) for r in edge_rows()), key=str)


def test_counts_on_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op5_quality_rules(spark, SF).collect():
        assert tuple(r)[1:7] == base(docs[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_labels(spark):
    large = "/root/testdata/sf0.1"  # sf0.01 holds 9 labelled rejects only
    labels = spark.read.parquet(f"{large}/labels.parquet")
    r = (op5_quality_rules(spark, large).where("not base_failed").join(labels, "doc_id").groupBy("quality")
         .agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect())
    kept = {x.quality: x.kept for x in r}
    assert kept[1] > 0.98 and kept[0] < 0.4


def test_references_and_distance_by_brute_force(spark):
    texts = [("the cat and the dog " * 30, "en"), ("der hund und die katze " * 30, "de"), ("a b c", None), (None, "en")]
    refs = quality.learn(spark.createDataFrame(texts, "text string, lang string").repartition(3))
    assert sorted(refs) == ["de", "en"]
    words = Counter(texts[0][0].split())
    assert sorted(w.decode() for w in refs["en"].at) == sorted(words)
    probe = "the the dog runs " * 20
    n = Counter(probe.split())
    vocab = sorted(words)
    p = [n[w] / 80 for w in vocab] + [20 / 80]
    q = [words[w] / 150 for w in vocab] + [0.0]
    assert refs["en"].word_distance(Counter(probe.encode().split())) == pytest.approx(distance(p, q))
    chars, letters = quality.class_counts(probe), quality.class_counts(texts[0][0])
    want = distance(list(chars / chars.sum()), list(letters / letters.sum()))
    assert quality.judge(probe, [refs["en"]])[7] == pytest.approx(want)


def test_guards_and_empty(spark):
    assert quality.quality(empty_frame(spark)).count() == 0
    assert quality.kept_documents(empty_frame(spark)).count() == 0
    short = quality.judge("## $$ " * 10, [quality.Reference(quality.class_counts("abc"), {}, 0)])
    assert short[6] is False and short[7] is None and short[8] is None
    assert quality.judge("w" * 10 + " x" * 80, [])[7:] == (None, None)


def test_kept_documents_keep_their_columns(spark):
    rows = [row(1, " ".join(f"w{i}" for i in range(90))), row(2, "too short"), row(3, None)]
    d = quality.kept_documents(spark.createDataFrame(rows, SCHEMA))
    assert d.columns == SCHEMA.names and [r.doc_id for r in d.collect()] == [1]
