import base64
import hashlib
from collections import Counter

import public_tokenizers as vocab
import tiktoken

import corpus_pipeline
from recolib.llm import mixing, quality
from tests.llm import test_mixing, test_neardup, test_secrets
from tests.llm.edge import SCHEMA, edge_frame, edge_rows, empty_frame

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def after_quality(rows):
    words, classes = {}, {}
    for _, text, lang, *_ in rows:
        if lang is not None and text is not None:
            words.setdefault(lang, Counter()).update(w.decode() for w in text.encode().lower().split())
            classes[lang] = classes.get(lang, 0) + quality.class_counts(text)
    refs = [quality.Reference(classes[k], {w: n for w, n in c.items() if n >= quality.COMMON_SHARE * c.total()}, c.total())
            for k, c in sorted(words.items())]
    return [r for r in rows if quality.judge(r[1], refs)[6]]


def after_dedup(rows):
    """One row of each class, found over rows (not ids): classes of whole texts, then the least id, then the text's
    digest, then any of the equal rows."""
    of = dict(test_neardup.brute_classes([(i, *r[1:]) for i, r in enumerate(rows)]))
    best = {}
    for i, r in enumerate(rows):
        if (r[1] or "").split():
            rank = (r[0] is None, r[0] or 0, hashlib.md5(r[1].encode()).hexdigest())
            best[of[i]] = min(best.get(of[i], (rank, r)), (rank, r), key=lambda x: x[0])
    return [r for _, r in best.values()] + [r for r in rows if not (r[1] or "").split()]


def after_redaction(rows):
    out = []
    for r in rows:
        text, at = "", 0
        for a, _, z in test_secrets.all_spans(r[1])[1]:
            if a >= at:
                text += r[1][at:a] + "[secret]"
            at = max(at, z)
        text += r[1][at:]
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def after_mixing(rows):
    out = []
    for r, (*_, target, taken) in zip(rows, test_mixing.brute(rows)):
        size = len(r[1].encode().split())
        out += [r] * (taken // size if size else 0)
    return out


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = rows_of(docs)
    key = lambda r: str(r)
    for (name, stage), brute in zip(corpus_pipeline.STAGES, (after_quality, after_dedup, after_redaction, after_mixing)):
        docs = spark.createDataFrame(rows, docs.schema) if rows else docs
        got, before = stage(spark, docs, SF), len(rows)
        assert got.columns == COLUMNS, name
        rows = brute(rows)
        assert sorted(rows_of(got), key=key) == sorted(rows, key=key), name
        assert rows and before
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(vocab.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = sorted((r[0], r[2], r[3], enc.encode_ordinary(r[1])) for r in rows)
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.lang, r.source, list(r.ids)) for r in out) == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out)


def test_edge_rows_and_empty(spark):
    for start in (edge_frame(spark), empty_frame(spark)):
        docs = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == SCHEMA.names
        n = docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == n
    # null texts pass the stages that do not judge them
    only = edge_frame(spark).where("text is null")
    assert only.count() == corpus_pipeline.secret_redaction(spark, only, SF).count()
    last = corpus_pipeline.bpe_encoding(spark, only, SF).collect()
    assert len(last) == only.count() and all(r.round_trip and r.n_tokens == 0 for r in last)
    assert mixing.mixed_documents(only).count() == 0 and edge_rows()


def test_repeated_ids_leave_one_row_a_class(spark):
    t = "a text of a good many words that another row repeats without any change at all in it " * 6
    near = t + "and one word"
    rows = [(1, t), (2, t), (2, "quite another text with words of its own " * 8), (5, t.upper()), (5, t.upper() + " END"),
            (None, near.title()), (7, near.title()), (8, None), (8, None), (None, "  ")]
    rows = [(i, x, "en", "a", None if x is None else len(x)) for i, x in rows]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = rows_of(corpus_pipeline.near_dedup(spark, d, SF))
    assert sorted(got, key=str) == sorted(after_dedup(rows), key=str)
    assert [r[0] for r in got].count(5) == 1 and sum(r[1] == t for r in got) == 1 and len(got) == 7
