"""64-bit hashes of all words of a batch of texts with NumPy, no Python loop over words.

A word's hash is a polynomial in its bytes modulo 2^64, taken from prefix sums
over the batch and divided by the power at its start (the base is odd, so it
has an inverse), then mixed.  It depends on the word's bytes alone.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once; longer input is cut at white space.
_SEGMENT = 1 << 20
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = 1 << (n - 1).bit_length()
        p = np.full(size, _BASE if kind == "up" else _INVERSE, np.uint64)
        p[0] = 1
        _powers[kind] = np.multiply.accumulate(p)
    return _powers[kind]


def _is_space(b: np.ndarray) -> np.ndarray:
    return (b == 32) | ((b >= 9) & (b <= 13))


def _segment(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate(([1], _is_space(b).view(np.int8), [1]))))
    start, end = edges[0::2], edges[1::2]
    prefix = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + U(1)) * _power("up", len(b))[:len(b)], out=prefix[1:])
    return mixed((prefix[end] - prefix[start]) * _power("down", len(b))[start]), start, end


class Words:
    """Words of several texts: ``hash``, byte ``start`` and ``end`` of each in
    ``raw``, and ``first``: the first word of every text, and their number."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        parts = [(t or "").encode("utf-8", "replace") for t in texts]
        self.raw = b"\n".join(parts) + b"\n"
        b = np.frombuffer(self.raw, np.uint8)
        if lower:
            b = np.where((b >= 65) & (b <= 90), b | 32, b)
        found, at = [], 0
        while at < len(b):
            to = min(len(b), at + _SEGMENT)
            if to < len(b):
                spaces = np.flatnonzero(_is_space(b[at:to]))
                while not len(spaces) and to < len(b):  # one word longer than a segment
                    to = min(len(b), to + _SEGMENT)
                    spaces = np.flatnonzero(_is_space(b[at:to]))
                if len(spaces):
                    to = at + int(spaces[-1]) + 1
            h, s, e = _segment(b[at:to])
            found.append((h, s + at, e + at))
            at = to
        self.hash, self.start, self.end = (np.concatenate(x) for x in zip(*found, strict=True))
        sizes = np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))
        self.first = np.searchsorted(self.start, np.concatenate(([0], np.cumsum(sizes))))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words (also across texts; one for each start that has n words)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    x = h[:len(h) - n + 1].copy()
    for j in range(1, n):
        x *= U(0xD6E8FEB86659FD93)
        x += h[j:len(h) - n + 1 + j]
        x ^= x >> U(32)
    return mixed(x + U(n))
