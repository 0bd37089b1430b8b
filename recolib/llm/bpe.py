"""Byte-level BPE encoding and decoding (operator 9).

The rank file is loaded once per worker. Its tokens, as Latin-1 strings, form an Aho-Corasick automaton; one
pass over a piece gives the longest token at every position (ends come in ascending order, so the last one seen for
a start is the longest), and the encoder walks those longest matches, falling back to the next shorter token (or one token back) whenever two neighbours cannot stand beside each other. Two
tokens can if merging their joined bytes by rank gives the same two tokens again; the answer is memoised per pair.
A position that was given up is never tried again, so the walk is linear in the piece's length.

Pieces (matches of the split pattern) are independent, so their ids are kept in a per-worker table of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"
# What a worker keeps: pieces of up to MAX_KEPT_CHARS characters (a few hundred bytes each, ids included) and answers
# about pairs (about a hundred bytes each), both below some 60 MB. A full table of pairs is emptied and refilled; of the
# pieces the older half goes, unless asked for since.
MAX_PIECES = 200_000
MAX_PAIRS = 500_000
MAX_KEPT_CHARS = 32
# Texts whose strings and ids are held at a time, whatever the size of the batch that Spark sends
TEXTS_AT_ONCE = 128


class ByteBPE:
    """Encoder and decoder for one file of ``base64-token rank`` lines."""

    def __init__(self, rank_path: str, pattern: str) -> None:
        with open(rank_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.token = {i: t for t, i in self.ranks.items()}
        self.size = {i: len(t) for t, i in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for t, i in self.ranks.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self.compatible: dict[int, bool] = {}  # by both ids in one number, half the size of a pair
        self.prefix: dict[int, int | None] = {}
        self.pieces = _Pieces(self)

    def merge(self, data: bytes) -> list[int]:
        """Ids by repeatedly joining the adjacent pair of lowest rank, leftmost first. Used on joined pairs only."""
        rank, none, cut = self.ranks.get, 1 << 60, list(range(len(data) + 1))
        joined = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]
        while joined and (best := min(joined)) != none:
            at = joined.index(best)
            del cut[at + 1], joined[at]
            if at < len(joined):
                joined[at] = rank(data[cut[at]:cut[at + 2]], none)
            if at:
                joined[at - 1] = rank(data[cut[at - 1]:cut[at + 1]], none)
        return [self.ranks[data[a:z]] for a, z in zip(cut, cut[1:])]

    def fits(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.compatible.get(key)
        if known is None:
            known = self.compatible[key] = self.merge(self.token[a] + self.token[b]) == [a, b]
        return known

    def shorter(self, i: int) -> int | None:
        """The longest token that is a proper prefix of token ``i``."""
        if i not in self.prefix:
            t = self.token[i]
            self.prefix[i] = next((self.ranks[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.ranks), None)
        return self.prefix[i]

    def encode_piece(self, data: bytes) -> list[int]:
        """The ids of one piece. A piece that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        longest = {end + 1 - size: i for end, (size, i) in self.automaton.iter(data.decode("latin-1"))}
        n, size, known, prefix = len(data), self.size, self.compatible.get, self.prefix
        ids: list[int] = []
        dead = bytearray(n + 1)  # positions given up
        pos = 0
        i = longest.get(0)
        before = None  # the token that ends at ``pos``
        while pos < n:
            while i is not None:
                if not dead[pos + size[i]]:
                    if before is None:
                        break
                    fit = known(before << 32 | i)
                    if fit or (fit is None and self.fits(before, i)):
                        break
                i = prefix[i] if i in prefix else self.shorter(i)
            if i is None:
                if before is None:
                    raise ValueError("the rank file lacks single bytes")
                dead[pos] = 1
                i = ids.pop()  # its end is dead now, so a shorter token follows
                pos -= size[i]
                before = ids[-1] if ids else None
            else:
                ids.append(i)
                pos += size[i]
                before, i = i, longest.get(pos)
        return ids

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.pattern.findall(text))), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


class _Pieces(dict):
    """Piece -> its ids as little-endian bytes. When half of ``MAX_PIECES`` are held they become the older half, from which
    a piece comes back if asked for, and those that were the older half go. Long pieces are not kept."""

    def __init__(self, bpe: ByteBPE) -> None:
        self.bpe = bpe
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        out = self.older.get(piece)
        if out is None:
            if len(self.bpe.compatible) > MAX_PAIRS:
                self.bpe.compatible.clear()
            out = pack("<%dI" % len(ids := self.bpe.encode_piece(piece.encode("utf-8"))), *ids)
        if len(piece) <= MAX_KEPT_CHARS:
            if len(self) >= MAX_PIECES // 2:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out


@lru_cache(maxsize=2)
def load(rank_path: str, pattern: str) -> ByteBPE:
    return ByteBPE(rank_path, pattern)


def round_trip(text: Column, rank_path: str, pattern: str) -> Column:
    """Struct of ``n_tokens``, ``ids_sha256`` (ids as little-endian u32) and ``decoded_sha256`` for a text column.
    A null text counts as empty: no ids, the digest of no bytes."""

    @F.pandas_udf(RESULT)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(rank_path, pattern)
        for texts in batches:
            rows = []
            for t in texts:
                ids = bpe.encode(t or "")
                rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
                             hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text)


def encoded_batches(batches: Iterator[pa.Array], bpe: ByteBPE) -> Iterator[pa.Array]:
    """The rows of :func:`encode_column` for batches of texts, ``TEXTS_AT_ONCE`` at a time."""
    for batch in batches:
        for at in range(0, len(batch), TEXTS_AT_ONCE):
            texts = [t or "" for t in batch.slice(at, TEXTS_AT_ONCE).to_pylist()]
            ids = [bpe.encode(t) for t in texts]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).view("<i4")))
            same = pa.array([bpe.decode(i) == t.encode("utf-8") for i, t in zip(ids, texts)])
            yield pa.StructArray.from_arrays([lists, same], ["ids", "round_trip"])


def encode_column(text: Column, rank_path: str, pattern: str) -> Column:
    """Struct of ``ids`` (array<int>; null text: empty) and ``round_trip``, whether decoding them gives the text's bytes.
    One function, so that a task has one Python worker and one copy of the tables. The batch stays in Arrow's form and the
    ids leave in small batches: a worker holds the strings and ids of ``TEXTS_AT_ONCE`` texts, not of a whole batch."""

    @F.arrow_udf("ids array<int>, round_trip boolean")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return encoded_batches(batches, load(rank_path, pattern))

    return encode(text)


def decode_column(ids: Column, rank_path: str, pattern: str) -> Column:
    """Bytes of an ``array<int>`` of ids (null array: null)."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(rank_path, pattern)
        for rows in batches:
            yield pd.Series([None if r is None else bpe.decode(np.asarray(r)) for r in rows])

    return decode(ids)


def bpe_digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Nulls: a null text is empty, a null doc_id is kept. Repeated rows each give a row; an empty table gives none.
    Other columns of ``docs`` are ignored, whatever their names. One narrow pass, no shuffle.
    """
    d = docs.select("doc_id", round_trip(F.col("text"), rank_path, pattern).alias("r"))
    return d.select("doc_id", "r.*")
