"""Leading eigenpairs of a symmetric matrix.

Householder reflections make the matrix tridiagonal, Sturm counts bisect the wanted
eigenvalues, inverse iteration gives their vectors, and vectors of close eigenvalues
are made orthogonal to each other in every step. The matrix has the size of a
vector's dimension squared, whatever the number of rows it came from.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps
# Eigenvalues closer than this share of the matrix norm form a cluster.
_CLOSE = 1e-3
_ROUNDS = 8


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the unit reflectors, in the order they were applied."""
    a = np.array(matrix, dtype=float)
    size = len(a)
    reflectors = []
    for j in range(size - 2):
        column = a[j + 1 :, j]
        u = column.copy()
        length = np.linalg.norm(column)
        edge = -np.copysign(length, column[0])
        u[0] -= edge
        norm = np.linalg.norm(u)
        if np.linalg.norm(column[1:]) <= _EPS * length or norm == 0.0:
            reflectors.append(np.zeros_like(u))
            continue
        u /= norm
        rest = a[j + 1 :, j + 1 :]
        p = rest @ u
        w = p - (u @ p) * u
        rest -= 2.0 * (np.outer(u, w) + np.outer(w, u))
        a[j + 1 :, j] = 0.0
        a[j + 1, j] = edge
        reflectors.append(u)
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each shift."""
    tiny = np.finfo(float).tiny / _EPS
    squared = off * off
    pivot = diagonal[0] - shifts
    count = (pivot < 0).astype(int)
    for d, e2 in zip(diagonal[1:], squared):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - shifts - e2 / pivot
        count += pivot < 0
    return count


def largest(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues, falling, by bisection to the last digit."""
    size = len(diagonal)
    spread = np.zeros(size)
    spread[:-1] += np.abs(off)
    spread[1:] += np.abs(off)
    low = np.full(wanted, (diagonal - spread).min())
    high = np.full(wanted, (diagonal + spread).max())
    pad = _EPS * size * max(abs(low[0]), abs(high[0])) + np.finfo(float).tiny
    low, high = low - pad, high + pad
    index = size - 1 - np.arange(wanted)
    while True:
        middle = low + (high - low) / 2
        if not ((low < middle) & (middle < high)).any():
            return middle
        above = below(diagonal, off, middle) > index
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def _factored(diagonal: np.ndarray, off: np.ndarray, least: float):
    """LU factors with row exchanges of a tridiagonal matrix; no pivot is below ``least``."""
    size = len(diagonal)
    d, upper, second = diagonal.copy(), np.append(off, 0.0), np.zeros(size)
    factor, swapped = np.zeros(size), np.zeros(size, dtype=bool)
    for i in range(size - 1):
        under = off[i]
        if abs(under) > abs(d[i]):
            swapped[i] = True
            factor[i] = d[i] / under
            d[i], upper[i], second[i], d[i + 1], upper[i + 1] = (
                under,
                d[i + 1],
                upper[i + 1],
                upper[i] - factor[i] * d[i + 1],
                -factor[i] * upper[i + 1],
            )
        else:
            if abs(d[i]) < least:
                d[i] = least
            factor[i] = under / d[i]
            d[i + 1] -= factor[i] * upper[i]
    if abs(d[-1]) < least:
        d[-1] = least
    return d, upper, second, factor, swapped


def _solved(factors, right: np.ndarray) -> np.ndarray:
    d, upper, second, factor, swapped = factors
    y = right.copy()
    for i in range(len(d) - 1):
        if swapped[i]:
            y[i], y[i + 1] = y[i + 1], y[i] - factor[i] * y[i + 1]
        else:
            y[i + 1] -= factor[i] * y[i]
    for i in range(len(d) - 1, -1, -1):
        if i + 1 < len(d):
            y[i] -= upper[i] * y[i + 1]
        if i + 2 < len(d):
            y[i] -= second[i] * y[i + 2]
        y[i] /= d[i]
    return y


def _orthogonal(vector: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in others:
            vector = vector - (other @ vector) * other
    return vector


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as rows, for falling ``values``."""
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(off).max() if len(off) else 0.0, np.finfo(float).tiny)
    draw = np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster: list[np.ndarray] = []
    for place, value in enumerate(values):
        if place and values[place - 1] - value > _CLOSE * norm:
            cluster = []
        # Equal values get slightly different shifts, so that factors differ too.
        shift = value - 4 * _EPS * norm * len(cluster)
        factors = _factored(diagonal - shift, off, _EPS * norm)
        vector = _orthogonal(draw.uniform(-1.0, 1.0, size), cluster)
        vector /= np.linalg.norm(vector)
        for _ in range(_ROUNDS):
            grown = _solved(factors, vector)
            grown = grown / np.abs(grown).max()
            grown = _orthogonal(grown / np.linalg.norm(grown), cluster)
            grown /= np.linalg.norm(grown)
            moved = min(np.linalg.norm(grown - vector), np.linalg.norm(grown + vector))
            vector = grown
            if moved < 4 * _EPS * np.sqrt(size):
                break
        found.append(vector)
        cluster.append(vector)
    return np.array(found)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as rows."""
    size = len(matrix)
    wanted = min(wanted, size)
    scale = np.abs(matrix).max()
    if scale == 0.0:
        return np.zeros(wanted), np.eye(size)[:wanted]
    scaled = matrix / scale
    diagonal, off, reflectors = tridiagonal((scaled + scaled.T) / 2)
    values = largest(diagonal, off, wanted)
    rows = vectors(diagonal, off, values)
    for j in range(len(reflectors) - 1, -1, -1):
        u = reflectors[j]
        rows[:, j + 1 :] -= 2.0 * np.outer(rows[:, j + 1 :] @ u, u)
    return values * scale, rows
