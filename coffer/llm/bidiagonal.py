"""Largest singular values of a small triangular matrix and their right singular vectors, by quotient differences.

Householder reflections make the matrix bidiagonal. The squares of the singular values are the eigenvalues of the
bidiagonal's own tridiagonal; dqds steps, which neither form that product nor subtract but for the shift, find them one
after the other from the smallest. Each wanted vector comes from a twisted factorisation: a stationary transform from the
top meets a progressive one from the bottom where the residual is least. All sizes here are the number of dimensions.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Steps per singular value; dqds needs about four.
STEPS = 100


def bidiagonalise(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of U' A V = B, upper bidiagonal, for a square A."""
    a, n = np.array(matrix, float), len(matrix)
    right = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = np.linalg.norm(x)
        v = x.copy()
        if size == 0:
            return v, 0.0
        v[0] += np.copysign(size, x[0])
        return v, 2.0 / (v @ v)

    for k in range(n):
        v, tau = reflector(a[k:, k])
        a[k:, k:] -= tau * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v, tau = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= tau * np.outer(a[k:, k + 1:] @ v, v)
            right[:, k + 1:] -= tau * np.outer(right[:, k + 1:] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One differential step with a shift; None where the shift is above the least eigenvalue."""
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        new_q[i] = d + e[i]
        if d < 0 or new_q[i] <= 0:
            return None
        ratio = q[i + 1] / new_q[i]
        new_e[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
    if d < 0:
        return None
    new_q[-1] = d
    return new_q, new_e, least


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal with no zero on it, in falling order."""
    parts = [(diagonal**2, above**2, 0.0)]
    found = []
    while parts:
        q, e, moved = parts.pop()
        for _ in range(STEPS * len(q)):
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            small = np.flatnonzero(e <= EPS**2 * (np.minimum(q[:-1], q[1:]) + moved))
            if len(small):
                at = small[-1] + 1
                parts.append((q[:at], e[:at - 1], moved))
                q, e = q[at:], e[at:]
                continue
            # Gershgorin for the symmetric tridiagonal gives a lower bound; a shift below it keeps the step positive
            root = np.sqrt(q[:-1] * e)
            centre = q + np.r_[0.0, e]
            bound = (centre - np.r_[0.0, root] - np.r_[root, 0.0]).min()
            tail = q[-1] * (1.0 - np.sqrt(e[-1] / (q[-1] + e[-1]))) ** 2 if e[-1] < q[-1] else 0.0
            step = None
            for shift in (tail, 0.75 * tail, max(bound, 0.0), 0.0):
                if (step := _dqds(q, e, shift)) is not None:
                    break
            q, e, moved = step[0], step[1], moved + shift
            if q[-1] == 0.0:  # the shift was an eigenvalue
                found.append(moved)
                q, e = q[:-1], e[:-1]
        else:
            raise ArithmeticError("dqds did not converge")
    return np.sort(found)[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float) -> np.ndarray:
    """Unit right singular vector of the bidiagonal for a squared singular value, by the best twist."""
    n, q, e = len(diagonal), diagonal**2, above**2
    tiny = EPS**2 * (q.max() + (e.max() if n > 1 else 0.0))
    # B'B - value: stationary from the top ...
    low, s = np.empty(n - 1), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        low[i] = diagonal[i] * above[i] / pivot
        s[i + 1] = s[i] * (e[i] / pivot) - value
    # ... and progressive from the bottom
    up, p = np.empty(n - 1), np.empty(n)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        up[i] = diagonal[i] * above[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    residual = s + p + value
    twist = int(np.abs(residual).argmin())
    z = np.zeros(n)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(twist, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def leading(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of the largest singular values of a square matrix, falling, and their right singular vectors as columns.

    At most ``most``, and none that is zero to double precision. Equal values get any orthonormal vectors of their space:
    a bidiagonal that falls into blocks is solved block by block, and vectors of near values are made orthogonal.
    """
    norm = np.linalg.norm(matrix)
    if norm == 0:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, above, right = bidiagonalise(matrix / norm)
    diagonal = np.where(np.abs(diagonal) < EPS**2, EPS**2, diagonal)
    cuts = np.flatnonzero(np.abs(above) <= EPS) + 1
    blocks = np.split(np.arange(len(diagonal)), cuts)
    pairs = []
    for block in blocks:
        a, b = diagonal[block], above[block[:-1]]
        pairs += [(value, block) for value in squared_singular_values(a, b)[:most]]
    pairs = sorted(pairs, key=lambda x: -x[0])[:most]
    values, vectors = [], []
    for value, block in pairs:
        if value <= (len(diagonal) * EPS) ** 2:
            break
        z = np.zeros(len(diagonal))
        z[block] = _apart(diagonal[block], above[block[:-1]], value, [v[block] for v in vectors])
        values.append(value * norm**2)
        vectors.append(z)
    return np.array(values), right @ np.array(vectors).reshape(-1, len(diagonal)).T


def _apart(diagonal: np.ndarray, above: np.ndarray, value: float, earlier: list[np.ndarray]) -> np.ndarray:
    """The vector of ``value``, orthogonal to those found before; a value met again is moved by a few units of rounding."""
    best = None
    for nudge in range(4):
        z = twisted_vector(diagonal, above, value * (1 - 4 * nudge * EPS))
        for _ in range(2):
            for v in earlier:
                z = z - (v @ z) * v
        size = np.linalg.norm(z)
        if best is None or size > best[0]:
            best = (size, z)
        if size > 0.5:
            break
    if best[0] <= EPS:
        raise ArithmeticError("two singular vectors coincide")
    return best[1] / best[0]
