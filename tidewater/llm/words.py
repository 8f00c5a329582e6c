"""64-bit hashes of words and word n-grams of whole texts, in numpy.

A word's hash is a polynomial over its bytes, taken from running sums, so no
Python code runs per word.  Long texts are cut at white space into chunks.
"""

from __future__ import annotations

import re

import numpy as np

CHUNK = 1 << 20
_GAPS = np.zeros(256, bool)
_GAPS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) mod 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        p = np.full(max(n, 1 << 16), base, np.uint64)
        p[0] = 1
        held = _powers[base] = np.cumprod(p, dtype=np.uint64)
    return held[:n]


def _chunk_hashes(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.uint8)
    inside = np.zeros(len(a) + 2, np.int8)
    inside[1:-1] = ~_GAPS[a]
    edge = np.flatnonzero(np.diff(inside))
    start, end = edge[::2], edge[1::2]
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTES[a] * _power(_STEP, len(a)), dtype=np.uint64, out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(pow(_STEP, -1, 2**64), len(a) + 1)[start])


def word_hashes(raw: bytes | None) -> np.ndarray:
    """One hash for each word of a UTF-8 text."""
    raw = raw or b""
    if len(raw) <= CHUNK:
        return _chunk_hashes(raw)
    parts, at = [], 0
    while at < len(raw):
        cut = _GAP.search(raw, min(at + CHUNK, len(raw)))
        end = cut.start() if cut else len(raw)
        parts.append(_chunk_hashes(raw[at:end]))
        at = end
    return np.concatenate(parts)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; [] if there are fewer."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    g = words[:count].copy()
    for i in range(1, n):
        g *= np.uint64(_BASE)
        g += words[i: i + count]
    return mix(g + np.uint64(n))


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text is one shingle."""
    return np.unique(gram_hashes(words, min(n, len(words)))) if len(words) else np.zeros(0, np.uint64)
