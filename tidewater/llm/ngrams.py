"""Hashed character n-grams of whole texts, in numpy.

A text is its code points followed by zeros, so every position starts one
n-gram of each length.  Texts are worked off in groups of bounded size and a
longer text in pieces that see the code points after them, so memory does not
depend on the text length and no n-gram is lost at a cut.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Code points held at once.
GROUP = 1 << 20
_MULT = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


def groups(texts: Sequence[str | None], pad: int, size: int = GROUP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(code points, first position, row) of pieces that together hold about
    ``size`` code points; a piece ends in ``pad`` zeros or in the code points
    that follow it.  Empty texts give no piece."""
    parts: list[np.ndarray] = []
    starts: list[int] = []
    rows: list[int] = []
    held, zeros = 0, np.zeros(pad, np.uint32)
    for row, text in enumerate(texts):
        points = code_points(text)
        for at in range(0, len(points), size):
            piece = points[at: at + size]
            after = points[at + size: at + size + pad]
            starts.append(held)
            rows.append(row)
            parts += [piece, after, zeros[len(after):]]
            held += len(piece) + pad
            if held >= size:
                yield np.concatenate(parts), np.array(starts), np.array(rows)
                parts, starts, rows, held = [], [], [], 0
    if parts:
        yield np.concatenate(parts), np.array(starts), np.array(rows)


def hashed(points: np.ndarray, starts: np.ndarray, pad: int, n: int, bits: int) -> np.ndarray:
    """Bucket (0 .. 2**bits - 1) of the n-gram at each position; positions in
    the padding of a piece get the bucket 2**bits."""
    length = len(points)
    h = np.full(length, (n * 0x7F4A7C15) & 0xFFFFFFFF, np.uint32)
    for i in range(n):
        h[: length - i] += points[i:] * np.uint32(_MULT[i])
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(16)
    out = (h >> np.uint32(32 - bits)).astype(np.int64)
    ends = np.append(starts[1:], length)
    for i in range(1, pad + 1):
        out[ends - i] = 1 << bits
    return out
