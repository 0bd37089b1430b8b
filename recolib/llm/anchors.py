"""Content-chosen anchors of byte strings: equal strings of ``LENGTH`` bytes have the same anchor inside them."""

from __future__ import annotations

import numpy as np

LENGTH = 200  # bytes of a repeat
GRAM = 64  # bytes of an anchor
SPAN = LENGTH - GRAM + 1  # anchor positions inside a string of LENGTH bytes
PIECE = 1 << 24  # strings whose anchors are chosen at a time
_POSITION_BITS = 25

_U64 = np.uint64
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, _U64)
    p[0] = 1
    return np.multiply.accumulate(p)


class Hasher:
    """Polynomial hashes of all substrings of one byte string, modulo 2^64."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.power = _powers(_BASE, n + 1)
        self.sums = np.zeros(n + 1, _U64)
        np.cumsum(_BYTE[data] * _powers(_INVERSE, n + 1)[:n], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        """Mixed hash of the ``size`` bytes from each position on."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.power[:n] + _U64(size)) if n > 0 else np.empty(0, _U64)

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.sums[stop] - self.sums[start]) * self.power[start] + (stop - start).astype(_U64))


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row: running minima inside blocks, forwards and backwards."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    y = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    y[:len(x)] = x
    y = y.reshape(blocks, width)
    ahead = np.minimum.accumulate(y, axis=1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, at, low, high) of a byte string: the anchor at ``at`` with hash ``key`` belongs to the strings of LENGTH
    bytes that start in low..high. Each such string's anchor is its leftmost gram of least hash, so it depends on the
    string's own bytes only. A string shorter than LENGTH has none."""
    found = []
    for first in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        part = data[first:first + PIECE + LENGTH - 1]
        g = Hasher(part).grams(GRAM)
        mask = _U64((1 << _POSITION_BITS) - 1)
        least = _window_least((g & ~mask) | np.arange(len(g), dtype=_U64), SPAN)
        at = (least & mask).astype(np.int64)
        cut = np.flatnonzero(np.diff(at)) + 1
        low = np.concatenate([[0], cut])
        high = np.concatenate([cut, [len(at)]]) - 1
        found.append((g[at[low]].view(np.int64), at[low] + first, low + first, high + first))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*found))
