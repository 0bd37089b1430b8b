import hashlib
import base64

import numpy as np
import pyarrow as pa
import public_tokenizers as vocab
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from recolib.llm import bpe
from tests.llm.edge import edge_frame, edge_rows, empty_frame

RANKS = vocab.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abethningéè手😀 0 \n\t'sxX<|>"), max_size=200))
def test_ids_equal_the_reference_library(text):
    b = bpe.load(RANKS, vocab.PATTERN)
    ranks = tiktoken.Encoding("own", pat_str=vocab.PATTERN, mergeable_ranks=b.ranks, special_tokens={})
    ids = b.encode(text)
    assert ids.tolist() == ranks.encode_ordinary(text)
    assert b.decode(ids) == text.encode()


def test_edge_rows(spark, reference):
    got = sorted(map(tuple, bpe.bpe_digests(edge_frame(spark), RANKS, vocab.PATTERN).collect()), key=str)
    want = []
    for r in edge_rows():
        ids = reference.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_empty_table_and_columns(spark):
    out = bpe.bpe_digests(empty_frame(spark), RANKS, vocab.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_id_columns_round_trip(spark):
    d = edge_frame(spark).withColumn("ids", bpe.encode_column("text", RANKS, vocab.PATTERN)["ids"])
    d = d.withColumn("bytes", bpe.decode_column("ids", RANKS, vocab.PATTERN))
    for r in d.select("text", "ids", "bytes").collect():
        assert bytes(r.bytes) == (r.text or "").encode() and (r.ids or not r.text)


def test_small_piece_table(spark, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 3)
    b = bpe.ByteBPE(RANKS, vocab.PATTERN)
    text = "one two three four five six seven one two three"
    assert b.decode(b.encode(text)) == text.encode() and len(b.pieces) <= 3


def test_answers_about_pairs_are_kept_by_one_number():
    import public_tokenizers

    from recolib.llm import bpe
    b = bpe.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert bytes(b.decode(b.encode("unlikely zzqxkv wörter"))) == "unlikely zzqxkv wörter".encode()
    assert b.compatible and all(type(k) is int for k in b.compatible)
    assert all(v == (b.merge(b.token[k >> 32] + b.token[k & 0xFFFFFFFF]) == [k >> 32, k & 0xFFFFFFFF]) for k, v in b.compatible.items())


def test_pieces_asked_for_again_outlive_a_full_table(monkeypatch):
    """op9: a full table was emptied, so frequent pieces were encoded anew each time."""
    monkeypatch.setattr(bpe, "MAX_PIECES", 8)
    b, encoded = bpe.ByteBPE(RANKS, vocab.PATTERN), []
    plain = b.encode_piece
    monkeypatch.setattr(b, "encode_piece", lambda data: encoded.append(data) or plain(data))
    words = [f" {a}{c}zq" for a in "abcdefg" for c in "hijklmn"]
    for w in words:
        assert b.decode(b.encode(f" often{w}")).decode() == f" often{w}"
    assert encoded.count(b" often") == 1 and len(encoded) == 1 + len(words)
    assert len(b.pieces) + len(b.pieces.older) <= 8


def test_a_large_batch_is_encoded_and_leaves_in_small_ones(spark):
    """pipeline, memory of bpe_encoding: a whole batch's strings and ids were held at once."""
    texts = [None if k % 7 == 0 else "" if k % 5 == 0 else f"token {k} " * (k % 4) for k in range(3 * bpe.TEXTS_AT_ONCE + 5)]
    b, read = bpe.load(RANKS, vocab.PATTERN), []
    source = (read.append(len(x)) or x for x in [pa.array(texts, pa.string()), pa.array([], pa.string()), pa.array(texts[:3], pa.string())])
    out = bpe.encoded_batches(source, b)
    first = next(out)
    assert len(first) == bpe.TEXTS_AT_ONCE and read == [len(texts)]
    rest = list(out)
    assert max(map(len, rest)) == bpe.TEXTS_AT_ONCE
    rows = [r for part in [first, *rest] for r in part.to_pylist()]
    assert rows == [{"ids": b.encode(t or "").tolist(), "round_trip": True} for t in texts + texts[:3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = docs.select("doc_id", bpe.encode_column("text", RANKS, vocab.PATTERN).alias("e")).select("doc_id", "e.*").collect()
    assert {r.doc_id: r.ids for r in got} == {k: b.encode(t or "").tolist() for k, t in enumerate(texts)}
