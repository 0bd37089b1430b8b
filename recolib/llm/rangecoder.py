"""Adaptive context-mixing range coder for blocks of token ids below 2^16.

Every block starts from fresh tables and is coded on its own. For each id the order-2 table (by the last two ids) and
the order-1 table (by the last id) each predict one id with a confidence of 0 to 3, and order-0 counts give the
shares of the id's upper parts. The joint confidence selects adaptive counts over ten events: the order-2 prediction
is right, the order-1 prediction is right, or neither and the id's top three bits; in the last case the next three
bits follow by counts of their own and the low ten bits evenly. Events drive a carryless 64-bit range coder that
writes 16-bit words. Many blocks are coded side by side, one id of each per step.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 14  # ids of a block
LANES = 1024  # blocks coded side by side
_SLOTS = 1 << 12
_RAW = 10
_STEP, _LIMIT, _LOW_LIMIT = 24, 1 << 13, 1 << 10
_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 40)
_WORD, _SIXTEEN = _U(48), _U(16)
_SUM = {n: np.triu(np.ones((n, n), np.float32)) for n in (8, 10)}  # counts stay far below 2^24: sums are exact


class _Lanes:
    """Model and coder state of blocks coded side by side."""

    def __init__(self, n: int) -> None:
        self.row = np.arange(n)
        self.id2, self.id1 = np.zeros((n, _SLOTS), np.uint16).ravel(), np.zeros((n, _SLOTS), np.uint16).ravel()
        self.sure2, self.sure1 = np.zeros(n * _SLOTS, np.uint8), np.zeros(n * _SLOTS, np.uint8)
        self.events = np.ones((n * 16, 10), np.float32)
        self.parts = np.ones((n * 8, 8), np.float32)
        self.last, self.last2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.low, self.span = np.zeros(n, _U), np.full(n, (1 << 64) - 1, _U)

    def shrink(self, n: int) -> None:
        """Go on with the first ``n`` lanes."""
        self.row, self.last, self.last2 = self.row[:n], self.last[:n], self.last2[:n]
        self.low, self.span = self.low[:n], self.span[:n]

    def look(self) -> None:
        """Predictions for the next id of every lane."""
        base = self.row * _SLOTS
        self.slot2 = base + ((self.last2 * 40503 + self.last * 10007) >> 3 & (_SLOTS - 1))
        self.slot1 = base + (self.last * 40503 >> 4 & (_SLOTS - 1))
        self.guess2, self.guess1 = self.id2.take(self.slot2), self.id1.take(self.slot1)
        self.trust2, self.trust1 = self.sure2.take(self.slot2), self.sure1.take(self.slot1)
        self.context = self.row * 16 + self.trust2 * 4 + self.trust1
        self.counts, self.cum, self.total = _shares(self.events, self.context)

    def learn(self, ids: np.ndarray, event: np.ndarray) -> None:
        """Update the tables with the id and event of every lane."""
        self._count(self.events, self.context, event, self.total, _LIMIT)
        for table, sure, slot, guess, trust in ((self.id2, self.sure2, self.slot2, self.guess2, self.trust2),
                                                (self.id1, self.sure1, self.slot1, self.guess1, self.trust1)):
            right = (guess == ids) & (trust > 0)
            change = ~right & (trust <= 1)
            sure[slot] = np.where(right, np.minimum(trust + 1, 3), np.where(change, 1, trust - 1))
            table[slot] = np.where(change, ids, guess)
        self.last2, self.last = self.last, ids

    @staticmethod
    def _count(table: np.ndarray, at: np.ndarray, symbol: np.ndarray, total: np.ndarray, limit: int) -> None:
        flat = table.reshape(-1)
        flat[at * table.shape[1] + symbol] += _STEP
        full = np.flatnonzero(total > limit - _STEP)
        if len(full):
            table[at[full]] = np.maximum(1, np.floor(table[at[full]] * 0.5))

    def learn_part(self, at: np.ndarray, part: np.ndarray, total: np.ndarray) -> None:
        self._count(self.parts, at, part, total, _LOW_LIMIT)

    def narrow(self, at, unit: np.ndarray, cum: np.ndarray, freq: np.ndarray) -> None:
        self.low[at] += unit * cum.astype(_U)
        self.span[at] = unit * freq.astype(_U)

    def settled(self) -> np.ndarray:
        """Lanes whose top word is settled, or whose span must be cut so that it is."""
        settled = (self.low ^ (self.low + self.span)) < _TOP
        short = ~settled & (self.span < _BOTTOM)
        if short.any():
            self.span[short] = (~self.low[short] + _U(1)) & (_BOTTOM - _U(1))
        return np.flatnonzero(settled | short)

    def shift(self, at: np.ndarray) -> None:
        self.low[at] <<= _SIXTEEN
        self.span[at] <<= _SIXTEEN


def _shares(table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a count table, their running sums, and their totals."""
    counts = table.take(at, axis=0)
    cum = counts @ _SUM[table.shape[1]]
    return counts, cum, cum[:, -1].astype(np.int64)


def _pick(cum: np.ndarray, counts: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(len(symbol)) * counts.shape[1] + symbol
    freq = counts.reshape(-1).take(at).astype(np.int64)
    return cum.reshape(-1).take(at).astype(np.int64) - freq, freq


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Payload of each block of ids (none empty, ids below 2^16), longest blocks first."""
    size = np.array([len(b) for b in blocks])
    if len(blocks) and (np.diff(size) > 0).any():
        raise ValueError("blocks come longest first")
    if any(b.max() >= 1 << 16 for b in blocks):
        raise ValueError("ids of 2^16 or more")
    steps = int(size[0]) if len(size) else 0
    grid = np.zeros((steps, len(blocks)), np.int64)
    for k, b in enumerate(blocks):
        grid[:len(b), k] = b
    s = _Lanes(len(blocks))
    lanes, words = [], []

    def emit(at: np.ndarray) -> None:
        lanes.append(at)
        words.append((s.low[at] >> _WORD).astype(np.uint16))
        s.shift(at)

    def close(first: int) -> None:  # the last four words of the lanes from ``first`` on
        at = np.arange(first, len(s.row))
        for _ in range(4):
            emit(at)
        s.shrink(first)

    for t in range(steps):
        n = int(np.searchsorted(-size, -t, side="left"))
        if n < len(s.row):
            close(n)
        s.look()
        ids = grid[t, :n]
        literal = ids >> (_RAW + 3)
        event = np.where((s.guess2 == ids) & (s.trust2 > 0), 9, np.where((s.guess1 == ids) & (s.trust1 > 0), 8, literal))
        cum, freq = _pick(s.cum, s.counts, event)
        s.narrow(slice(None), s.span // s.total.astype(_U), cum, freq)
        rest = np.flatnonzero(event < 8)
        if len(rest):
            at, part = rest * 8 + event[rest], (ids[rest] >> _RAW) & 7
            counts, below, total = _shares(s.parts, at)
            cum, freq = _pick(below, counts, part)
            unit = s.span[rest] // (total.astype(_U) << _U(_RAW))
            s.narrow(rest, unit, (cum << _RAW) + (ids[rest] & ((1 << _RAW) - 1)) * freq, freq)
            s.learn_part(at, part, total)
        s.learn(ids, event)
        while len(at := s.settled()):
            emit(at)
    if len(s.row):
        close(0)
    if not lanes:
        return []
    lane, word = np.concatenate(lanes), np.concatenate(words)
    order = np.argsort(lane, kind="stable")
    ends = np.cumsum(np.bincount(lane, minlength=len(blocks)))
    return [w.astype("<u2").tobytes() for w in np.split(word[order], ends[:-1])]


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The blocks of ids that ``encode`` gave ``payloads`` for; sizes in descending order."""
    size = np.array(sizes)
    if not len(size):
        return []
    steps = int(size[0])
    length = np.array([len(p) // 2 for p in payloads])
    start = np.concatenate([[0], np.cumsum(length)[:-1]])
    stream = np.concatenate([*(np.frombuffer(p, "<u2") for p in payloads), np.zeros(4, np.uint16)]).astype(_U)
    s = _Lanes(len(payloads))
    code = np.zeros(len(payloads), _U)
    at_word = start.copy()
    for _ in range(4):
        code = (code << _SIXTEEN) | stream[at_word]
        at_word += 1
    grid = np.zeros((steps, len(payloads)), np.int64)
    for t in range(steps):
        n = int(np.searchsorted(-size, -t, side="left"))
        if n < len(s.row):
            s.shrink(n)
            code, at_word = code[:n], at_word[:n]
        s.look()
        unit = s.span // s.total.astype(_U)
        target = np.minimum((code - s.low) // unit, (s.total - 1).astype(_U)).astype(np.int64)
        event = (s.cum <= target[:, None].astype(np.float32)).sum(axis=1)
        cum, freq = _pick(s.cum, s.counts, event)
        s.narrow(slice(None), unit, cum, freq)
        ids = np.where(event == 9, s.guess2, s.guess1).astype(np.int64)
        rest = np.flatnonzero(event < 8)
        if len(rest):
            at = rest * 8 + event[rest]
            counts, below, total = _shares(s.parts, at)
            unit = s.span[rest] // (total.astype(_U) << _U(_RAW))
            target = np.minimum((code[rest] - s.low[rest]) // unit,
                                ((total << _RAW) - 1).astype(_U)).astype(np.int64)
            part = (below <= (target >> _RAW)[:, None].astype(np.float32)).sum(axis=1)
            cum, freq = _pick(below, counts, part)
            raw = (target - (cum << _RAW)) // freq
            s.narrow(rest, unit, (cum << _RAW) + raw * freq, freq)
            ids[rest] = (event[rest] << (_RAW + 3)) | (part << _RAW) | raw
            s.learn_part(at, part, total)
        grid[t, :n] = ids
        s.learn(ids, event)
        while len(at := s.settled()):
            code[at] = (code[at] << _SIXTEEN) | stream[at_word[at]]
            at_word[at] += 1
            s.shift(at)
    return [grid[:k, j].astype(np.uint32) for j, k in enumerate(size)]
