"""Suffix-array removal of repeated byte strings (operator 7).

A byte goes if a string of ``LENGTH`` bytes over it starts anywhere else too. Equal strings have equal anchors
(``anchors``), so only strings whose anchor's hash occurs twice can repeat:

1. Anchor hashes are counted (combined per task before the shuffle). A bit table of ``FILTER_BITS`` bits of those
   found twice goes to every task; a false hit costs traffic, never a result.
2. Each surviving anchor's context, the bytes of all strings it stands for, goes to the anchor's group, once per
   task and content; its occurrences stay behind as short rows.
3. In a group, strings whose anchor lies in the same ``BLOCK`` of offsets share a core of LENGTH - BLOCK + 1 bytes.
   Contexts with equal cores are laid end to end, the core as one symbol, and sorted by their suffixes (``suffix``);
   neighbours in that order that agree over a whole string are repeats. Many groups are sorted side by side.
   An anchor with more than ``GROUP_ROWS`` contexts (a short passage in very many documents) is not gathered in a group:
   the strings of its contexts are counted by their 128-bit hashes instead, wherever they are.
4. Marked ranges go back to the occurrences and are merged per document, where the bytes are cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recolib.llm.anchors import LENGTH, anchors
from recolib.llm.common import columns, stored
from recolib.llm.suffix import suffix_orders

BLOCK = 17
WINDOW = BLOCK  # symbols of a string of LENGTH bytes once its core is one symbol
FILTER_BITS = 1 << 27
MAX_SENT = 500_000  # contexts a task remembers having sent
GROUP_ROWS = 20_000  # contexts of the largest group that is sorted; fewer than twice as many are held at a time
SORT_SYMBOLS = 1 << 20

RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
OCCURRENCES = "doc_id long, h long, low int, key long, c long, shift int, context binary"


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def repeated_anchors(texts: DataFrame) -> np.ndarray:
    """Bit table of the anchor hashes found at least twice, FILTER_BITS / 8 bytes whatever the corpus."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = [anchors(_bytes(t))[0] for t in pdf["text"]]
            if keys:
                key, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pd.DataFrame({"key": key, "n": n})

    bit = F.col("key").bitwiseAND(FILTER_BITS - 1)
    words = columns(texts.mapInPandas(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1")
             .groupBy(F.shiftright(bit, 6).alias("at"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))).alias("word")))
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["at"]] = words["word"]
    return table


def occurrences(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Rows of ``OCCURRENCES`` for (doc_id, h, text): one per anchor that passes the bit table; ``context`` is null
    where the task has sent the same one already."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, sent = shared.value, set()
        for pdf in batches:
            rows = []
            for doc_id, h, text in zip(pdf["doc_id"], pdf["h"], pdf["text"]):
                data = (text or "").encode()
                key, at, low, high = anchors(np.frombuffer(data, np.uint8))
                bit = key & (FILTER_BITS - 1)
                hit = (table[bit >> 6] >> (bit & 63)) & 1 == 1
                for k, a, lo, hi in zip(key[hit].tolist(), at[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                    context = data[lo:hi + LENGTH]
                    c = xxhash.xxh64_intdigest(context) - (1 << 63)
                    if (k, c) in sent:
                        context = None
                    else:
                        if len(sent) >= MAX_SENT:
                            sent.clear()
                        sent.add((k, c))
                    rows.append((doc_id, h, lo, k, c, a - lo, context))
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in OCCURRENCES.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return docs.mapInPandas(run, OCCURRENCES)


def _marks(groups: list[list[tuple[bytes, bytes, int]]]) -> list[np.ndarray]:
    """For each group (left bytes, right bytes, times seen) of contexts around one core: which of its strings repeat,
    as one boolean array over all left positions and the core, context after context."""
    order = sorted(range(len(groups)), key=lambda g: sum(len(a) + len(b) + 2 for a, b, _ in groups[g]))
    out: list[np.ndarray] = [np.empty(0, bool)] * len(groups)
    at = 0
    while at < len(order):
        stop, total = at, 0
        while stop < len(order) and (stop == at or total < SORT_SYMBOLS):
            total += sum(len(a) + len(b) + 2 for a, b, _ in groups[order[stop]])
            stop += 1
        symbols = np.empty(total, np.int32)
        starts, valid, k = [0], np.zeros(total, bool), 0
        for g in order[at:stop]:
            for i, (left, right, _) in enumerate(groups[g]):
                n = len(left)
                symbols[k:k + n] = np.frombuffer(left, np.uint8)
                symbols[k + n] = 256
                symbols[k + n + 1:k + n + 1 + len(right)] = np.frombuffer(right, np.uint8)
                symbols[k + n + 1 + len(right)] = 257 + i
                # a string starts where WINDOW symbols with the core in them follow
                valid[k:k + n + len(right) + 2 - WINDOW] = True
                k += n + len(right) + 2
            starts.append(k)
        bounds = np.array(starts)
        rank = suffix_orders(symbols, bounds)
        padded = np.concatenate([symbols, np.full(WINDOW, -1, np.int32)])
        a, b = rank[:-1], rank[1:]
        both = valid[a] & valid[b]
        both[bounds[1:-1] - 1] = False  # the last of one group and the first of the next
        a, b = a[both], b[both]
        same = (padded[a[:, None] + np.arange(WINDOW)] == padded[b[:, None] + np.arange(WINDOW)]).all(axis=1)
        hit = np.zeros(total, bool)
        hit[a[same]] = True
        hit[b[same]] = True
        for j, g in enumerate(order[at:stop]):
            k, parts = bounds[j], []
            for left, right, times in groups[g]:
                n = len(left) + len(right) + 2 - WINDOW  # strings of this context
                parts.append(hit[k:k + n] | (times > 1))
                k += len(left) + len(right) + 2
            out[g] = np.concatenate(parts)
        at = stop
    return out


def repeats_in(contexts: list[tuple[int, int, bytes, int]]) -> list[np.ndarray]:
    """Of contexts (group key, shift of the anchor, bytes, times seen), distinct within a group: for each, which of
    its strings of LENGTH bytes occur twice in its group."""
    found = [np.zeros(len(data) - LENGTH + 1, bool) for _, _, data, _ in contexts]
    cores: dict[tuple[int, int, bytes], list[tuple[int, int, int]]] = {}
    for i, (key, shift, data, _) in enumerate(contexts):
        last = len(data) - LENGTH  # strings start at 0..last, the anchor's offset in them is shift..shift - last
        for block in range((shift - last) // BLOCK, shift // BLOCK + 1):
            first_offset = block * BLOCK
            lo, hi = max(0, shift - first_offset - BLOCK + 1), min(last, shift - first_offset)
            core = data[shift - first_offset:shift - first_offset - BLOCK + 1 + LENGTH]
            cores.setdefault((key, block, core), []).append((i, lo, hi))
    groups, owners = [], []
    for (_, block, core), members in cores.items():
        alike: dict[tuple[bytes, bytes], list] = {}
        for i, lo, hi in members:
            _, shift, data, times = contexts[i]
            begin = shift - block * BLOCK
            sides = data[lo:begin], data[begin + len(core):hi + LENGTH]
            held = alike.setdefault(sides, [0, []])
            held[0] += times
            held[1].append((i, lo, hi))
        if sum(times for times, _ in alike.values()) > 1:
            groups.append([(*sides, times) for sides, (times, _) in alike.items()])
            owners.append([own for _, own in alike.values()])
    for group, own, marks in zip(groups, owners, _marks(groups)):
        k = 0
        for (left, right, _), places in zip(group, own):
            n = len(left) + len(right) + 2 - WINDOW
            for i, lo, hi in places:
                found[i][lo:hi + 1] |= marks[k:k + n]
            k += n
    return found


def _runs(marks: np.ndarray) -> list[int]:
    """Flat list of first, last of each run of marks."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    edge[1::2] -= 1
    return edge.tolist()


def _contexts(seen: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Distinct contexts with their times seen: those in groups of up to GROUP_ROWS, and those of larger groups (None when
    there are none)."""
    def distinct(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key", "c").agg(F.count("*").alias("times"), F.any_value("shift").alias("shift"),
                                            F.any_value("context", True).alias("context"))

    large = stored(seen.where("context is not null").groupBy("key").agg(F.count("*").alias("n"))
                   .where(F.col("n") > GROUP_ROWS).select("key"), "large")
    if large.isEmpty():
        return distinct(seen), None
    return distinct(seen.join(large, "key", "left_anti")), distinct(seen.join(large, "key", "left_semi"))


def _marks_by_hash(contexts: DataFrame) -> DataFrame:
    """(key, c, marks) of contexts in groups of any size: each string's hash is counted over all of them."""
    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                rows = []
                for key, c, times, data in pdf[["key", "c", "times", "context"]][at:at + 1000].itertuples(index=False):
                    rows += [(key, c, times, i, xxhash.xxh3_128_digest(data[i:i + LENGTH]))
                             for i in range(len(data) - LENGTH + 1)]
                yield pd.DataFrame(rows, columns=["key", "c", "times", "at", "string"])

    strings = stored(contexts.mapInPandas(hashes, "key long, c long, times long, at int, string binary"), "strings")
    repeated = strings.groupBy("string").agg(F.sum("times").alias("n")).where("n > 1").select("string")
    return strings.join(repeated, "string").groupBy("key", "c").agg(
        F.flatten(F.collect_list(F.array("at", "at"))).alias("marks"))


def repeat_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, h, ranges): for rows of ``docs`` (doc_id, h, text) with a repeat, flat pairs of the first and last start
    of strings of LENGTH bytes that occur elsewhere too."""
    table = repeated_anchors(docs.select("text"))
    seen = stored(occurrences(docs, table), "occurrences")
    contexts, large = _contexts(seen)

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def done(rows: list[tuple]) -> pd.DataFrame:
            out = []
            for (key, c, _, _, _), marks in zip(rows, repeats_in([(r[0], r[2], r[3], r[4]) for r in rows])):
                if marks.any():
                    out.append((key, c, _runs(marks)))
            return pd.DataFrame(out, columns=["key", "c", "marks"]).astype({"key": "int64", "c": "int64"})

        held: list[tuple] = []
        for pdf in batches:
            for row in zip(pdf["key"], pdf["c"], pdf["shift"], pdf["context"], pdf["times"]):
                if len(held) >= GROUP_ROWS and row[0] != held[-1][0]:
                    yield done(held)
                    held = []
                held.append(row)
        if held:
            yield done(held)

    marked = (contexts.repartition("key").sortWithinPartitions("key")
              .mapInPandas(mark, "key long, c long, marks array<int>"))
    if large is not None:
        marked = marked.unionByName(_marks_by_hash(large))
    back = seen.select("doc_id", "h", "low", "key", "c").join(marked, ["key", "c"])
    shifted = F.transform("marks", lambda m: m + F.col("low"))
    return back.select("doc_id", "h", shifted.alias("marks")).groupBy("doc_id", "h").agg(
        F.flatten(F.collect_list("marks")).alias("ranges"))


def _cut(text: str | None, ranges) -> tuple[bytes, int, int]:
    """Bytes that stay, number of maximal removed runs, number of bytes in all."""
    data = _bytes(text)
    if ranges is None or not len(ranges):
        return data.tobytes(), 0, len(data)
    r = np.asarray(ranges).reshape(-1, 2)
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, r[:, 0], 1)
    np.add.at(change, r[:, 1] + LENGTH, -1)
    gone = np.cumsum(change[:-1]) > 0
    return data[~gone].tobytes(), len(_runs(gone)) // 2, len(data)


def _with_ranges(docs: DataFrame) -> DataFrame:
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.withColumn("h", F.xxhash64("text"))
    r = repeat_ranges(d.select("doc_id", "h", "text"))
    return d.alias("d").join(r.alias("r"), F.expr("d.doc_id <=> r.doc_id and d.h = r.h"), "left").select(
        "d.doc_id", "d.text", "r.ranges")


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Texts are UTF-8 bytes; a null text has none and the digest of no bytes. Rows repeating a text repeat all its strings,
    rows of one doc_id included; a null doc_id is kept. An empty table gives no rows; other columns are ignored."""
    @F.pandas_udf(RESULT)
    def digest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, ranges in batches:
            rows = []
            for text, r in zip(texts, ranges):
                kept, spans, n = _cut(text, r)
                rows.append((n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()))
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in RESULT.split(", ")])

    return _with_ranges(docs).select("doc_id", digest("text", "ranges").alias("r")).select("doc_id", "r.*")


def kept_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, kept): the bytes that stay, concatenated. A cut may fall inside a UTF-8 character."""
    @F.pandas_udf("binary")
    def keep(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, ranges in batches:
            yield pd.Series([_cut(t, r)[0] for t, r in zip(texts, ranges)], dtype=object)

    return _with_ranges(docs).select("doc_id", keep("text", "ranges").alias("kept"))
