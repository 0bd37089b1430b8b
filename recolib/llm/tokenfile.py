"""Token-id files (operator 8): documents' ids in ascending doc_id order, coded in checksummed blocks.

Files are Parquet rows, one per block: ``part`` (rank of the doc_id range it comes from), ``block`` (its number in the
part), ``first`` (position of its first id in the part), ``running`` (number of the document that runs into it),
``n_ids``, ``crc32`` of its ids as little-endian u32, ``payload`` (see ``rangecoder``), and for each document that
begins in the block its id, length and the position of its first id in the part. Parts are ranges of doc_id, cut by
sampling, so no task handles more than one range and the order of parts is the order of ids. A reader needs no
block but its own: a document that runs over several blocks gets its checksum by combining theirs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolib.llm import rangecoder
from recolib.llm.common import shared_path

MAX_PIECES = 400_000
FILE = ("part int, block long, first long, running long, n_ids int, crc32 long, payload binary, doc_no array<long>, doc_id array<long>, "
        "doc_start array<long>, doc_size array<long>")
PIECES = "part int, block long, doc_no long, doc_id long, doc_start long, n long, crc long"


class Encoder(dict):
    """Ids of text by a tokenizer file, as little-endian u32 bytes. Strings of the file's added tokens are cut out first,
    as the library does. The split pattern's matches are independent in a byte-level tokenizer, so the library is asked
    once per distinct match; the table is bounded."""

    def __init__(self, path: str, pattern: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pattern = regex.compile(pattern)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.clear()
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        out = self[piece] = np.array(ids, "<u4").tobytes()
        return out

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if not self.added or not self.cut.search(text):
            parts = map(self.__getitem__, self.pattern.findall(text))
        else:
            parts = (self.added[p] if k % 2 else b"".join(map(self.__getitem__, self.pattern.findall(p)))
                     for k, p in enumerate(self.cut.split(text)))
        return np.frombuffer(b"".join(parts), "<u4")


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def write(docs: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each document and write the files under ``path``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer_path, pattern)
        end = np.array([end_id], "<u4")
        held: list[np.ndarray] = []  # ids not yet in a block
        index: list[tuple[int, int | None, int, int]] = []  # (doc number, doc_id, start, size)
        n_held = block = at = doc_no = running = 0

        def coded(last: bool) -> pd.DataFrame:
            nonlocal held, index, n_held, block, running
            ids = np.concatenate(held) if held else np.empty(0, "<u4")
            whole = len(ids) if last else len(ids) - len(ids) % rangecoder.BLOCK
            blocks = [ids[i:i + rangecoder.BLOCK] for i in range(0, whole, rangecoder.BLOCK)]
            first, rows, k = at - len(ids), [], 0
            for b, payload in zip(blocks, rangecoder.encode(blocks)):
                stop = first + len(b)
                own = []
                while k < len(index) and index[k][2] < stop:
                    own.append(index[k])
                    k += 1
                columns = [list(x) for x in zip(*own)] or [[], [], [], []]
                rows.append((part, block, first, running, len(b), zlib.crc32(b.tobytes()), payload, *columns))
                running = own[-1][0] if own else running
                first, block = stop, block + 1
            held, index, n_held = [ids[whole:]], index[k:], len(ids) - whole
            return pd.DataFrame(rows, columns=[f.split()[0] for f in FILE.split(", ")])

        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype(object), pdf["text"]):
                ids = np.concatenate([enc.encode(text), end])
                index.append((doc_no, None if pd.isna(doc_id) else int(doc_id), at, len(ids)))
                held.append(ids)
                n_held, at, doc_no = n_held + len(ids), at + len(ids), doc_no + 1
                if n_held >= rangecoder.LANES * rangecoder.BLOCK:
                    yield coded(False)
        yield coded(True)

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
     .mapInPandas(run, FILE).write.parquet(path))


def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """Batches of file rows, longest blocks first, with their ids. A block that fails its checksum raises."""
    for pdf in batches:
        for at in range(0, len(pdf), rangecoder.LANES):
            rows = pdf.iloc[at:at + rangecoder.LANES].sort_values("n_ids", ascending=False, kind="stable")
            blocks = rangecoder.decode(rows["payload"].tolist(), rows["n_ids"].tolist())
            for b, crc, part, block in zip(blocks, rows["crc32"], rows["part"], rows["block"]):
                if zlib.crc32(b.astype("<u4").tobytes()) != crc:
                    raise ValueError(f"block {block} of part {part} is damaged")
            yield rows, blocks


def crc32_join(first: int, second: int, size: int) -> int:
    """crc32 of two byte strings end to end from theirs, ``size`` being the second's length: the first one's remainder
    moves on by as many zero bytes, by repeated squaring of that step as a matrix over GF(2)."""
    def times(matrix: list[int], vector: int) -> int:
        out = k = 0
        while vector:
            if vector & 1:
                out ^= matrix[k]
            vector >>= 1
            k += 1
        return out

    step = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit
    bits = 8 * size
    while bits:
        if bits & 1:
            first = times(step, first)
        step = [times(step, x) for x in step]
        bits >>= 1
    return first ^ second


def read(spark, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (over all parts), n_tokens, ids_crc32."""
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, blocks in decoded(batches):
            out = []
            for r, ids in zip(rows.itertuples(), blocks):
                first = r.first
                data = memoryview(ids.astype("<u4").tobytes())
                at = min([len(ids), *(s - first for s in r.doc_start[:1])])
                if at:  # the rest, or a middle part, of the document running into the block
                    out.append((r.part, r.block, r.running, None, None, at, zlib.crc32(data[:4 * at])))
                for no, doc_id, start, n in zip(r.doc_no, r.doc_id, r.doc_start, r.doc_size):
                    a, z = start - first, min(start - first + n, len(ids))
                    out.append((r.part, r.block, no, doc_id, start, z - a, zlib.crc32(data[4 * a:4 * z])))
            done = pd.DataFrame(out, columns=[f.split()[0] for f in PIECES.split(", ")])
            yield done.astype({"doc_id": "Int64", "doc_start": "Int64"})

    @F.pandas_udf("long")
    def joined(lists: pd.Series) -> pd.Series:
        out = []
        for rows in lists:
            crc = rows[0]["crc"]
            for r in rows[1:]:
                crc = crc32_join(crc, r["crc"], 4 * r["n"])
            out.append(crc)
        return pd.Series(out)

    files = spark.read.schema(FILE).parquet(path)
    offset, offsets = 0, []
    for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        offsets.append((r.part, offset))
        offset += r.n
    parts = spark.createDataFrame(offsets, "part int, offset long")  # a row per part
    docs = (files.mapInPandas(pieces, PIECES).groupBy("part", "doc_no")
            .agg(F.max("doc_id").alias("doc_id"), F.max("doc_start").alias("doc_start"), F.sum("n").alias("n_tokens"),
                 F.array_sort(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces")))
    return docs.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("offset") + F.col("doc_start")).alias("start"), "n_tokens", joined("pieces").alias("ids_crc32"))


def token_file_digests(docs: DataFrame, tokenizer_path: str, pattern: str, end_id: int) -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back: one row per input row with doc_id, start,
    n_tokens, ids_crc32.

    A null text is empty and has its end id only. Documents go by doc_id with nulls first, rows of one id by text
    (null first); an empty table gives no rows. Other columns are ignored."""
    path = shared_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer_path, pattern, end_id)
    return read(docs.sparkSession, path)
