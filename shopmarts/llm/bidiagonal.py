"""Singular values and right singular vectors of a small triangular matrix by
Householder bidiagonalisation, dqds and twisted factorisations."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(np.float64).eps
TINY = np.finfo(np.float64).tiny


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``diagonal, above, w`` of a square matrix: an upper bidiagonal B with
    ``r = u @ B @ w.T`` for some orthogonal u, by Householder reflections from
    the left and the right in turn."""
    a, n = np.array(r, np.float64), len(r)
    w = np.eye(n)
    for k in range(n):
        v, beta = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(beta * v, v @ a[k:, k:])
        if k < n - 2:
            v, beta = _reflector(a[k, k + 1:])
            a[k:, k + 1:] -= np.outer(a[k:, k + 1:] @ v, beta * v)
            w[:, k + 1:] -= np.outer(w[:, k + 1:] @ v, beta * v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta so that ``x - beta * v * (v @ x)`` has only its first entry."""
    scale = np.abs(x).max(initial=0.0)
    if scale == 0 or len(x) == 1:
        return np.zeros_like(x), 0.0
    v = x / scale
    v[0] += np.copysign(np.linalg.norm(v), v[0])
    return v, 2 / (v @ v)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling.

    Works on q (squares of the diagonal) and e (squares above it).  Each step is a
    differential quotient-difference transform with a shift below the smallest
    value, so nothing is ever subtracted but the shift, and even tiny values
    come out to high relative accuracy.  The shift is Newton's: the inverses of an
    unshifted transform's pivots add up to the trace of the inverse of B B',
    whose own inverse bounds the smallest value from below and closes in on it.
    """
    found = []
    blocks = [(np.square(diagonal, dtype=np.float64), np.square(above, dtype=np.float64), 0.0)]
    left = 200 * len(diagonal) + 200
    while blocks:
        q, e, shift = blocks.pop()
        while len(q) > 1:
            left -= 1
            if left < 0:
                raise ArithmeticError("dqds does not converge")
            # an e that changes nothing beside its neighbours splits the block
            weak = np.flatnonzero(e <= EPS * EPS * (shift + np.minimum(q[:-1], q[1:])))
            if len(weak):
                k = int(weak[-1])
                blocks.append((q[:k + 1], e[:k], shift))
                q, e = q[k + 1:], e[k + 1:]
                continue
            if q[0] < q[-1]:                     # turned round it has the same values,
                q, e = q[::-1], e[::-1]          # and the smallest come out at the end
            plain = _step(q, e, 0.0)
            s = (1 - 4 * EPS) / np.sum(1 / plain[2]) if plain[2].min() > TINY else 0.0
            after = _step(q, e, s) if s else plain
            if after[2].min() < 0:               # too large by rounding
                s, after = 0.0, plain
            (q, e), shift = after[:2], shift + s
        found.extend(shift + q)
    return np.sqrt(np.sort(np.array(found, np.float64))[::-1])


def _step(q: np.ndarray, e: np.ndarray, s: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One differential transform with shift ``s``: new q and e, and the pivots."""
    n = len(q)
    q2, e2, d = np.empty(n), np.empty(n - 1), np.empty(n)
    d[0] = q[0] - s
    for i in range(n - 1):
        q2[i] = d[i] + e[i]
        t = q[i + 1] / q2[i] if q2[i] else 0.0
        e2[i] = e[i] * t
        d[i + 1] = d[i] * t - s
    q2[-1] = d[-1]
    return q2, e2, d


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Right singular vector of the bidiagonal with diagonal ``a`` and ``b`` above it
    for a singular value, from the twisted factorisation of B'B less its square:
    eliminated from the top and from the bottom, the two meet where the pivot is
    least, and the vector follows from there by products alone."""
    n, lam = len(a), value * value
    q, e, off = a * a, b * b, a[:-1] * b
    small = max(EPS * EPS * lam, TINY)
    top, down = np.empty(n), np.empty(n - 1)
    top[0] = -lam
    for i in range(n - 1):
        pivot = top[i] + q[i] or small
        down[i] = off[i] / pivot
        top[i + 1] = e[i] * (top[i] / pivot) - lam
    low, up = np.empty(n), np.empty(n - 1)
    low[-1] = q[-1] - lam
    for i in range(n - 2, -1, -1):
        pivot = e[i] + low[i + 1] or small
        up[i] = off[i] / pivot
        low[i] = q[i] * (low[i + 1] / pivot) - lam
    r = int(np.argmin(np.abs(top + low + lam)))
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, others: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - others @ (others.T @ z)
    return z


def _residual(a: np.ndarray, b: np.ndarray, value: float, x: np.ndarray) -> float:
    """Length of ``(B'B - value**2) x`` for x of unit length."""
    bx = a * x
    bx[:-1] += b * x[1:]
    y = a * bx
    y[1:] += b * bx[:-1]
    return float(np.linalg.norm(y - value * value * x) / np.linalg.norm(x))


def _inverse_iteration(a: np.ndarray, b: np.ndarray, value: float, same: np.ndarray,
                       scale: float, x: np.ndarray) -> np.ndarray:
    """A singular vector for ``value`` apart from ``same``, from any start."""
    t = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    t[1:, 1:] += np.diag(b * b)
    t -= np.eye(len(a)) * (value * value + 8 * EPS * scale * scale)
    for _ in range(4):
        x = _apart(np.linalg.solve(t, x / np.linalg.norm(x)), same)
    return x


def right_vectors(diagonal: np.ndarray, above: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values, falling, and the right singular vectors of the first ``k``
    as columns.

    The matrix is split where the value above the diagonal is nothing beside the
    largest; vectors of different parts are orthogonal as they are.  Vectors of
    one part are made orthogonal to those before; one that this leaves without a
    direction, or that does not fit its value, is found again by inverse iteration.
    """
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    cuts = [0, *(np.flatnonzero(np.abs(above) <= EPS * scale) + 1).tolist(), n]
    parts = [(s, e, dqds(diagonal[s:e], above[s:e - 1])) for s, e in zip(cuts, cuts[1:])]
    order = sorted(((v, s, e) for s, e, values in parts for v in values), key=lambda x: -x[0])
    z, values = np.zeros((n, k)), np.array([v for v, _, _ in order])
    rng = np.random.default_rng(7)
    for j, (v, s, e) in enumerate(order[:k]):
        a, b = diagonal[s:e], above[s:e - 1]
        same = z[s:e, [i for i in range(j) if order[i][1] == s]]
        x = _apart(_twisted(a, b, v), same)
        if np.linalg.norm(x) < 0.5 or _residual(a, b, v, x) > 1e3 * EPS * scale * scale:
            x = _inverse_iteration(a, b, v, same, scale, rng.standard_normal(e - s))
        z[s:e, j] = x / np.linalg.norm(x)
    return values, z


def principal_directions(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """All singular values of a square matrix, falling, and its first ``k`` right
    singular vectors as columns, each with its largest entry positive."""
    diagonal, above, w = bidiagonalise(r)
    values, z = right_vectors(diagonal, above, min(k, len(r)))
    v = w @ z
    if v.size:
        v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return values, v
