"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The pivots of an LDLt factorisation of A - sI have as many positive ones as A
has eigenvalues above s (Sylvester's law of inertia). Bisection on these counts
isolates one eigenvalue after the other, from the largest on; Rayleigh quotient
iteration, started inside the interval, then converges cubically. Counts just
above and below the value found certify its number; if they do not, or the
iteration left the interval, the interval is halved and tried again.

Eigenvalues that are equal up to rounding cannot be told apart by counts; the
vectors of such a group are any orthonormal basis of their space.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + 17**0.5) / 8  # balances the growth of one- and two-column pivots
_EPS = np.finfo(float).eps


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: positive pivots of LDLt with symmetric pivoting."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        two = False
        if most and abs(a[k, k]) < _ALPHA * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(a[r, k:])
            row[r - k] = 0.0
            if abs(a[k, k]) * row.max() < _ALPHA * most**2:
                two = abs(a[r, r]) < _ALPHA * row.max()
                swap(k + two, r)
        if two:  # a pivot of two columns has one positive and one negative eigenvalue
            positive += 1
            c = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            k += 2
            continue
        pivot = a[k, k]
        if pivot:
            positive += pivot > 0
            c = a[k + 1 :, k].copy()
            a[k + 1 :, k + 1 :] -= np.outer(c, c / pivot)
        k += 1
    return int(positive)


def _solve(matrix: np.ndarray, shift: float, v: np.ndarray, tiny: float) -> np.ndarray:
    """A unit vector along (A - shift I)^-1 v; a shift that hits an eigenvalue exactly is moved by rounding."""
    for k in range(8):
        try:
            y = np.linalg.solve(matrix - (shift + k * tiny) * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(y)
        if np.isfinite(size) and size:
            return y / size
    return v


def _without(v: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for u in found:
            v = v - (u @ v) * u
    size = np.linalg.norm(v)
    return v / size if size else v


def _iterate(matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], scale: float, refine: bool) -> tuple[float, np.ndarray, float]:
    """(value, vector, residual) near the middle of an interval."""
    n, tiny = len(matrix), _EPS * scale
    v = _without(np.cos(np.arange(1, n + 1) ** 2 * 1.0), found)  # any start that favours no axis
    for _ in range(3):
        v = _without(_solve(matrix, (low + high) / 2, v, tiny), found)
    value = float(v @ matrix @ v)
    residual = float(np.linalg.norm(matrix @ v - value * v))
    for _ in range(12 if refine else 0):
        u = _without(_solve(matrix, value, v, tiny), found)
        next_value = float(u @ matrix @ u)
        next_residual = float(np.linalg.norm(matrix @ u - next_value * u))
        if next_residual >= residual:
            break
        v, value, residual = u, next_value, next_residual
    return value, v, residual


def leading(matrix: np.ndarray, count: int) -> list[tuple[float, np.ndarray]]:
    """The ``count`` largest eigenvalues above rounding (at most as many as there are), falling, with unit vectors.

    The matrix is symmetric and without negative eigenvalues. Of the two signs,
    a vector has the one that makes its largest entry positive.
    """
    n = len(matrix)
    size = float(np.abs(matrix).max(initial=0.0))
    if not size or not np.isfinite(size):
        return []
    matrix = matrix / size
    top = float(np.abs(matrix).sum(axis=1).max())  # no eigenvalue is above it
    floor, tiny = n * _EPS * top, 4 * n * _EPS * top
    known = {floor: count_above(matrix, floor), top * 1.01: 0}
    found: list[tuple[float, np.ndarray]] = []
    for j in range(1, min(count, known[floor]) + 1):
        # What counts say so far: at least j above low, fewer than j above high.
        low = max(s for s, c in known.items() if c >= j)
        high = min(s for s, c in known.items() if c < j)
        vectors = [v for _, v in found]
        while True:
            alone = known[low] == j and known[high] == j - 1
            if alone or high - low <= tiny:
                value, v, residual = _iterate(matrix, low, high, vectors, top, alone)
                spread = max(4 * residual, tiny)
                if high - low <= tiny or (
                    low - tiny <= value <= high + tiny and residual <= 64 * n * _EPS * top
                    and count_above(matrix, value + spread) < j <= count_above(matrix, value - spread)
                ):
                    break
            middle = (low + high) / 2
            known[middle] = count_above(matrix, middle)
            if known[middle] >= j:
                low = middle
            else:
                high = middle
        found.append((value, v * (1.0 if v[np.abs(v).argmax()] > 0 else -1.0)))
    return [(value * size, v) for value, v in found]
