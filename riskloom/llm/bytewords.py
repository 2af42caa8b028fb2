"""64-bit hashes of a text's words, vectorised over its bytes."""

from __future__ import annotations

import hashlib

import numpy as np

SEGMENT = 1 << 16  # bytes hashed at once, so memory doesn't grow with a text
_BASE = 0x9E3779B97F4A7C15
U = np.uint64


def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.empty(SEGMENT + 1, U), np.empty(SEGMENT + 1, U)
    a = b = 1
    for i in range(SEGMENT + 1):
        up[i], down[i] = a, b
        a, b = a * _BASE % (1 << 64), b * inverse % (1 << 64)
    return up, down


_UP, _DOWN = _powers()
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def word_bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that aren't white space."""
    gap = np.ones(len(x) + 2, bool)
    gap[1:-1] = IS_SPACE[x]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


def hash_words(x: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word's bytes, mixed with its length."""
    out = np.empty(len(starts), U)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = int(np.searchsorted(ends, base + SEGMENT, "right"))
        if last <= first:  # one word longer than a segment
            digest = hashlib.blake2b(x[base : ends[first]].tobytes(), digest_size=8).digest()
            out[first] = int.from_bytes(digest, "little")
            first += 1
            continue
        s, e = starts[first:last] - base, ends[first:last] - base
        n = int(e[-1])
        upto = np.zeros(n + 1, U)
        np.cumsum((x[base : base + n].astype(U) + U(1)) * _UP[:n], out=upto[1:])
        out[first:last] = mix64((upto[e] - upto[s]) * _DOWN[s] + (e - s).astype(U))
        first = last
    return out


def lowered(text: str) -> np.ndarray:
    """The text's bytes with A-Z lower-cased."""
    return np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)


def word_hashes(text: str) -> np.ndarray:
    x = lowered(text)
    return hash_words(x, *word_bounds(x))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of each run of ``size`` words; the whole sequence if there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    h = np.full(n - width + 1, width, U)
    for k in range(width):
        h = h * U(0xD6E8FEB86659FD93) + words[k : n - width + 1 + k]
    return mix64(h)
