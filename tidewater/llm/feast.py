"""Eigenpairs of a symmetric matrix by contour integration (FEAST), in numpy.

Inertia: by Sylvester's law a symmetric A has as many eigenvalues above s as
A - s I has positive pivots.  Bisection on that count cuts the spectrum into
intervals with few eigenvalues each, at places where the gap is wide.

One interval: the resolvent (z I - A)^-1 is integrated over a circle through
the interval's ends by a quadrature of ``NODES`` complex shifts; applied to a
block of vectors it projects them onto the eigenvectors inside.  Rayleigh-Ritz
on the projected block gives the pairs; projections are repeated on the Ritz
vectors until their residuals are at rounding level.  The number found must be
the number that inertia counted, otherwise the block grows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Quadrature nodes on the upper half circle.
NODES = 8
#: Most eigenvalues an interval should hold, if they can be told apart.
PER_INTERVAL = 8
PASSES = 24
_EPS = float(np.finfo(float).eps)


@dataclass
class Interval:
    low: float
    high: float
    count: int


def count_above(a: np.ndarray, shift: float) -> int:
    """Eigenvalues of ``a`` above ``shift``, from the inertia of a - shift I
    (Bunch-Kaufman-like pivots: the largest diagonal entry, or a 2 x 2 block)."""
    m = a - shift * np.eye(len(a))
    positive, k = 0, 0
    n = len(m)
    while k < n:
        rest = m[k:, k:]
        diagonal = np.abs(np.diagonal(rest))
        p = int(np.argmax(diagonal))
        off = np.abs(np.tril(rest, -1))
        biggest = off.max() if n - k > 1 else 0.0
        if diagonal[p] >= 0.64 * biggest:
            if diagonal[p] == 0.0:
                break  # nothing is left but zeros
            _swap(m, k, k + p)
            positive += m[k, k] > 0
            m[k + 1:, k + 1:] -= np.outer(m[k + 1:, k], m[k, k + 1:]) / m[k, k]
            k += 1
        else:  # a 2 x 2 block with one eigenvalue of either sign
            i, j = np.unravel_index(int(np.argmax(off)), off.shape)
            _swap(m, k, k + int(j))
            _swap(m, k + 1, k + int(i))
            positive += 1
            block = m[k: k + 2, k: k + 2]
            m[k + 2:, k + 2:] -= m[k + 2:, k: k + 2] @ np.linalg.solve(block, m[k: k + 2, k + 2:])
            k += 2
    return positive


def _swap(m: np.ndarray, i: int, j: int) -> None:
    if i != j:
        m[[i, j]] = m[[j, i]]
        m[:, [i, j]] = m[:, [j, i]]


def _bounds(a: np.ndarray) -> tuple[float, float]:
    radius = np.abs(a).sum(axis=1) - np.abs(np.diagonal(a))
    return float((np.diagonal(a) - radius).min()), float((np.diagonal(a) + radius).max())


def intervals(a: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[Interval]:
    """Intervals that hold the ``wanted`` largest eigenvalues (and those equal
    to the last of them), from the top down.  Eigenvalues closer than about
    1e-10 of the largest stay in one interval, however many they are."""
    low, high = _bounds(a)
    pad = max(abs(low), abs(high), 1e-300) * 1e-6
    low, high = low - pad, high + pad
    smallest = 2.0**20 * _EPS * max(abs(low), abs(high))
    out: list[Interval] = []
    todo = [(low, high, len(a), 0)]  # (low, high, above low, above high)
    while todo:
        lo, hi, above_lo, above_hi = todo.pop()
        if above_lo == above_hi or above_hi >= wanted:
            continue
        held = above_lo - above_hi
        if (held <= per_interval and above_lo <= wanted) or hi - lo <= smallest:
            out.append(Interval(lo, hi, held))
            continue
        mid = (lo + hi) / 2
        above = count_above(a, mid)
        todo += [(lo, mid, above_lo, above), (mid, hi, above, above_hi)]
    return sorted((_trim(a, x, smallest) for x in out), key=lambda x: -x.low)


def _trim(a: np.ndarray, x: Interval, smallest: float, steps: int = 12) -> Interval:
    """Moves both ends to the eigenvalues inside, then out again by about half
    of the gap beyond them, so that the circle crosses the axis in the gaps."""
    above_low, above_high = count_above(a, x.low), count_above(a, x.high)
    low, high = x.low, x.high
    beyond = high
    for _ in range(steps):
        mid = (low + beyond) / 2
        low, beyond = (mid, beyond) if count_above(a, mid) == above_low else (low, mid)
    beyond = low
    for _ in range(steps):
        mid = (beyond + high) / 2
        high, beyond = (mid, beyond) if count_above(a, mid) == above_high else (high, mid)
    reach = max((high - low) / 2, smallest)
    down = up = reach / 64
    while down < 64 * reach and count_above(a, low - 2 * down) == above_low:
        down *= 2
    while up < 64 * reach and count_above(a, high + 2 * up) == above_high:
        up *= 2
    return Interval(low - down, high + up, x.count)


def solve(a: np.ndarray, x: Interval) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) in an interval."""
    n = len(a)
    centre, radius = (x.low + x.high) / 2, (x.high - x.low) / 2
    angle, weight = np.polynomial.legendre.leggauss(NODES)
    theta = np.pi * (1 - angle) / 2
    shifts = centre + radius * np.exp(1j * theta)
    scale = max(np.abs(_bounds(a)).max(), 1e-300)
    block = x.count + max(4, x.count // 2)
    while True:
        block = min(n, block)
        y = np.linalg.qr(np.random.default_rng(x.count).standard_normal((n, block)))[0]
        for _ in range(PASSES):
            q = np.zeros_like(y)
            for z, t, w in zip(shifts, theta, weight, strict=True):
                q += w / 2 * np.real(radius * np.exp(1j * t) * np.linalg.solve(z * np.eye(n) - a, y))
            basis = np.linalg.svd(q, full_matrices=False)[0]
            values, small = np.linalg.eigh(basis.T @ a @ basis)
            y = basis @ small
            residual = np.linalg.norm(a @ y - y * values, axis=0)
            inside = (values > x.low) & (values <= x.high) & (residual <= 256 * _EPS * scale * np.sqrt(n))
            if inside.sum() == x.count:
                order = np.argsort(-values[inside], kind="stable")
                return values[inside][order], y[:, inside][:, order]
        if block == n:
            raise ArithmeticError(f"{x.count} eigenvalues counted in ({x.low}, {x.high}], {int(inside.sum())} found")
        block *= 2


def polish(a: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz over the vectors of all intervals together: orthonormal to
    rounding, eigenvalues falling."""
    basis = np.linalg.qr(vectors)[0]
    values, small = np.linalg.eigh(basis.T @ a @ basis)
    order = np.argsort(-values, kind="stable")
    return values[order], basis @ small[:, order]
