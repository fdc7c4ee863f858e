"""Polynomial prefix hashes over bytes in numpy, and content-chosen anchors of windows."""

from __future__ import annotations

import numpy as np

#: An odd multiplier; arithmetic is modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
PLACE = np.uint64((1 << 24) - 1)
#: Windows of a text whose anchors are chosen together; bounds memory, and below PLACE.
BLOCK = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


_cache: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    got = _cache.get(base)
    if got is None or len(got) < n:
        got = _cache[base] = _powers(base, max(n, 1 << 16))
    return got[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits (its low bits depend on few input bits)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def prefix(data: np.ndarray) -> np.ndarray:
    """prefix[i]: hash of the first i bytes; ``data`` is uint8."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def spans(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for arrays of bounds, whatever their place."""
    return (pre[end] - pre[start]) * powers(INVERSE, len(pre))[start]


def anchors(data: np.ndarray, length: int, gram: int, block: int = BLOCK):
    """Cut all windows of ``length`` bytes by the place of their smallest gram.

    Returns arrays (place, first, n, gram hash, piece hash): windows starting at
    first .. first + n - 1 have their smallest gram (leftmost of equals) at ``place``.
    Equal windows choose the same gram at the same distance from their start. The piece
    is the bytes of these windows together. Long texts are worked on in blocks of windows,
    at whose borders pieces are cut as well.
    """
    n_win = len(data) - length + 1
    if n_win <= 0:
        return None
    if n_win > block:
        parts = []
        for a in range(0, n_win, block):
            at, first, n, g, piece = _anchors(data[a:a + block + length - 1], length, gram)
            parts.append((at + a, first + a, n, g, piece))
        return tuple(map(np.concatenate, zip(*parts)))
    return _anchors(data, length, gram)


def _anchors(data: np.ndarray, length: int, gram: int):
    n_win = len(data) - length + 1
    pre = prefix(data)
    inv = powers(INVERSE, len(pre))
    h = mixed((pre[gram:] - pre[:-gram]) * inv[:len(pre) - gram])
    low = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    width, step = length - gram + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[:step - width], low[width - step:])
    place = (low & PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    n = np.diff(np.append(first, n_win))
    at = place[first]
    end = first + n + length - 1
    piece = mixed(spans(pre, first, end) + (end - first).astype(np.uint64))
    return at, first, n, h[at], piece
