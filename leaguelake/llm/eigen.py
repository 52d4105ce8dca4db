"""Leading eigenvectors of a symmetric matrix: tridiagonal form, Sturm counts, inverse iteration.

For matrices as wide as a vector has entries, small enough for one machine.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(np.float64).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """diagonal, off-diagonal and q with q @ T @ q.T == matrix, by Householder reflections."""
    a = np.array(matrix, np.float64)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k]
        tail = np.linalg.norm(x[1:])
        if tail == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(np.hypot(x[0], tail), x[0])
        v /= np.linalg.norm(v)
        # Both sides of the remaining square, as one symmetric change of rank two.
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ x)
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each number: the negative pivots of T - at (Sturm)."""
    squares = np.concatenate([[0.0], off * off])
    tiny = np.finfo(np.float64).tiny / _EPS
    pivot = np.ones_like(at)
    below = np.zeros(at.shape, np.int64)
    for value, square in zip(diagonal, squares, strict=True):
        pivot = (value - at) - square / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection of all of them at once to the last bit."""
    d = len(diagonal)
    radius = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    margin = 2 * _EPS * max(np.abs(low).max(), np.abs(high).max()) + np.finfo(np.float64).tiny
    low, high = low - margin, high + margin
    wanted = d - np.arange(k)  # the i-th largest has this many eigenvalues at or below it
    for _ in range(2100):
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        over = count_below(diagonal, off, middle) >= wanted
        high, low = np.where(over, middle, high), np.where(over, low, middle)
    return low + (high - low) / 2


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; a vanishing pivot becomes a tiny one."""
    d = len(diagonal)
    scale = max(np.abs(diagonal).max(), np.abs(off).max() if d > 1 else 0.0, np.finfo(np.float64).tiny)
    main, upper, upper2 = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    x = right.copy()
    for i in range(d - 1):
        lower = off[i]
        if abs(lower) > abs(main[i]):
            main[i], lower = lower, main[i]
            upper[i], main[i + 1] = main[i + 1], upper[i]
            upper2[i], upper[i + 1] = upper[i + 1], 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        if main[i] == 0:
            main[i] = _EPS * scale
        factor = lower / main[i]
        main[i + 1] -= factor * upper[i]
        upper[i + 1] -= factor * upper2[i]
        x[i + 1] -= factor * x[i]
    if abs(main[-1]) < _EPS * scale:
        main[-1] = _EPS * scale
    for i in range(d - 1, -1, -1):
        if i + 1 < d:
            x[i] -= upper[i] * x[i + 1]
        if i + 2 < d:
            x[i] -= upper2[i] * x[i + 2]
        x[i] /= main[i]
        peak = np.abs(x[i:]).max()
        if peak > 1e250:
            x /= peak
    return x / np.linalg.norm(x)


def _vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of T as columns, by inverse iteration; those of one cluster are kept orthogonal."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max() if d > 1 else 0.0)
    near = 1e-3 * norm
    apart = 4 * _EPS * norm
    random = np.random.default_rng(11)
    found = np.empty((d, len(values)))
    cluster, shift = 0, np.inf
    for i, value in enumerate(values):
        if i and values[i - 1] - value > near:
            cluster = i
        # Equal shifts would give equal vectors: they are kept a little apart.
        shift = min(value, shift - apart) if i > cluster else value
        earlier = found[:, cluster:i]
        x = random.standard_normal(d)
        for _ in range(6):
            for _ in range(2):
                x -= earlier @ (earlier.T @ x)
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x))
        for _ in range(2):
            x -= earlier @ (earlier.T @ x)
        found[:, i] = x / np.linalg.norm(x)
    return found


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns."""
    scale = np.abs(matrix).max() if matrix.size else 0.0
    if scale == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, off, q = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    return values * scale, q @ _vectors(diagonal, off, values)
