"""Sets of hashed word shingles of whole texts, in vector operations over the texts' bytes.

Words are runs of bytes other than ASCII white space, A-Z lower-cased.  A word's hash is polynomial
in its bytes modulo 2**64 (by prefix sums), mixed; a shingle's hash combines its words' hashes.  Two
shingles count as equal when their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Texts are hashed together up to so many bytes (a longer text by itself).
CHUNK_BYTES = 1 << 18
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES + 64), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if n <= CHUNK_BYTES + 64:
            _powers[base] = known
    return known[:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start byte, hash) of each word."""
    data = _LOWER[np.frombuffer(raw, np.uint8)]
    gap = _SPACE[data]
    edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    total = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), dtype=np.uint64)
    total = np.concatenate((np.zeros(1, np.uint64), total))
    value = (total[end] - total[start]) * _power(_INVERSE, len(data) + 1)[start]
    return start, mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _combine(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x5851F42D4C957F2D) + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def shingle_sets(texts: list[str | None], n: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words, but not none, is one shingle."""
    at = 0
    while at < len(texts):
        raw, size = [], 0
        while at < len(texts) and (not raw or size < CHUNK_BYTES):
            raw.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            size += len(raw[-1]) + 1
            at += 1
        starts = np.cumsum([0, *[len(x) + 1 for x in raw]])
        first, words = word_hashes(b"\n".join(raw) + b"\n")
        bounds = np.searchsorted(first, starts)
        grams = _combine(words, n) if len(words) >= n else np.zeros(0, np.uint64)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            else:
                yield _combine(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)
