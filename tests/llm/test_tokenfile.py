import zlib

import numpy as np
import public_tokenizers as vocab
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from recolib.llm import rangecoder, tokenfile
from recolib.llm.queries import op8_token_files
from tests.llm.edge import edge_frame, edge_rows, empty_frame

SF = "/root/testdata/sf0.001"
JSON = vocab.path("byte_bpe_50k.json")


def brute(rows):
    t = Tokenizer.from_file(JSON)
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    out, at = [], 0
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids + [2]
        out.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_documents_equal_the_library(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op8_token_files(spark, SF)) == brute(rows)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext|", "x <|endoftext|>\n"])
def test_strings_of_added_tokens(text):
    ids = tokenfile.Encoder(JSON, vocab.PATTERN).encode(text)
    assert ids.tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids


def test_edge_rows_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(rangecoder, "BLOCK", 50)
    monkeypatch.setattr(rangecoder, "LANES", 7)
    d = tokenfile.token_file_digests(edge_frame(spark), JSON, vocab.PATTERN, 2)
    assert got(d) == brute(edge_rows())
    assert tokenfile.token_file_digests(empty_frame(spark), JSON, vocab.PATTERN, 2).count() == 0


def test_damage_is_found(spark, tmp_dir):
    path = tmp_dir + "/tokens"
    tokenfile.write(spark.read.parquet(f"{SF}/documents.parquet"), path, JSON, vocab.PATTERN, 2)
    rows = spark.read.parquet(path).toPandas()
    payload = bytearray(rows.loc[0, "payload"])
    payload[20] ^= 1
    rows.loc[0, "payload"] = bytes(payload)
    with pytest.raises(ValueError, match="damaged"):
        list(tokenfile.decoded(iter([rows])))


ids = st.one_of(st.lists(st.integers(0, 3), min_size=1, max_size=300),
                st.lists(st.integers(0, 65535), min_size=1, max_size=300))


@settings(max_examples=60, deadline=None)
@given(st.lists(ids, min_size=1, max_size=9))
def test_coder_round_trip(blocks):
    blocks = sorted((np.array(b) for b in blocks), key=len, reverse=True)
    payloads = rangecoder.encode(blocks)
    back = rangecoder.decode(payloads, [len(b) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, back, strict=True))
    # a block is coded alike alone
    assert rangecoder.encode(blocks[-1:])[0] == payloads[-1]


def test_repeats_cost_little():
    text = np.tile(np.array([500, 40000, 7, 12, 999]), 800)
    assert len(rangecoder.encode([text])[0]) < 0.35 * 2 * len(text)
    with pytest.raises(ValueError):
        rangecoder.encode([np.array([1 << 16])])


@given(st.binary(max_size=200), st.binary(max_size=200))
def test_joined_checksums(a, b):
    assert tokenfile.crc32_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
