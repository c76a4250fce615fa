"""Words of a text: maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased."""

from __future__ import annotations

import numpy as np

#: Every other ASCII character becomes a space, A-Z become a-z; bytes of other characters stay.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[32] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64) of a new array."""
    t = x >> np.uint64(30)
    t ^= x
    t *= np.uint64(0xBF58476D1CE4E5B9)
    t ^= t >> np.uint64(27)
    t *= np.uint64(0x94D049BB133111EB)
    t ^= t >> np.uint64(31)
    return t


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_pow, _inv = _powers(_R, 1 << 14), _powers(_RINV, 1 << 14)


def word_hashes(text: str) -> np.ndarray:
    """64-bit hash of each word, in order: a polynomial over its bytes, by prefix sums."""
    global _pow, _inv
    b = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(_TABLE), np.uint8)
    if len(b) >= len(_pow):
        _pow, _inv = _powers(_R, 2 * len(b)), _powers(_RINV, 2 * len(b))
    gap = np.concatenate([[True], _SPACE[b], [True]])
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edges[::2], edges[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUE[b] * _pow[: len(b)], out=sums[1:])
    return mix((sums[end] - sums[start]) * _inv[start])


_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(text: str, size: int = 5) -> np.ndarray:
    """64-bit hash of each run of ``size`` words, in order; of all words if there are fewer; none without words."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        if i and i % len(_PLACE) == 0:
            out = mix(out)
        out += h[i : n + i] * _PLACE[i % len(_PLACE)]
    return mix(out)


def elements(text: str, size: int = 5) -> np.ndarray:
    """Sorted hashes of (shingle, how often it has come before): set operations on these are multiset operations on shingles."""
    s = np.sort(shingles(text, size))
    if not len(s):
        return s
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    nth = np.arange(len(s)) - np.repeat(first, np.diff(np.concatenate([first, [len(s)]])))
    again = nth > 0
    if again.any():
        s[again] = mix(s[again] + nth[again].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        s.sort()
    return s
