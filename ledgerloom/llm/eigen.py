"""Eigenvectors of a symmetric matrix by mixed-precision refinement.

float32 eigenvectors are corrected by the iterations of Ogita and Aishima, which
need matrix products only.  Products are taken with about twice the digits of a
double: matrices are cut into slices of so few bits that the products of two
slices are exact, and the products are added with their rounding errors.
Eigenvalues closer to each other than the error of a round are a cluster: the
iteration only makes the cluster's space accurate, and a small solve of the
matrix within that space, less its mean, turns the vectors into place.
"""

from __future__ import annotations

import numpy as np

SLICES = 4
ROUNDS = 20
DONE = 2.0**-48


def slices(a: np.ndarray, inner: int) -> list[np.ndarray]:
    """``a`` as a sum; products of two slices over ``inner`` terms are exact."""
    bits = (53 - int(np.ceil(np.log2(max(inner, 2))))) // 2
    parts = []
    for _ in range(SLICES - 1):
        top = np.abs(a).max(initial=0.0)
        if top == 0:
            break
        shift = 1.5 * 2.0 ** (np.ceil(np.log2(top)) + 52 - bits)
        parts.append((a + shift) - shift)
        a = a - parts[-1]
    return [*parts, a]


def product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a @ b`` as the sum of two matrices, the second one a correction."""
    high = np.zeros((a.shape[0], b.shape[1]))
    low = np.zeros_like(high)
    right = slices(b, len(b))
    for i, left in enumerate(slices(a, len(b))):
        for part in right[: SLICES - i]:
            term = left @ part
            total = high + term
            taken = total - high
            low += (high - (total - taken)) + (term - taken)
            high = total
    return high, low


def _measured(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far ``x`` is from orthonormal, ``x' a x``, and the eigenvalues."""
    high, low = product(x.T, x)
    off = (np.eye(len(a)) - high) - low
    high, low = product(a, x)
    first, second = product(x.T, high)
    inside = first + (second + x.T @ low)
    return off, inside, np.diag(inside) / (1 - np.diag(off))


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Places of eigenvalues that chain up in steps of ``near`` at most."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def eigh(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and unit eigenvectors as columns."""
    top = np.abs(matrix).max(initial=0.0)
    if top == 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    scale = 2.0 ** np.ceil(np.log2(top))
    a = matrix / scale
    size = np.linalg.norm(a)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    known = None
    for _ in range(ROUNDS):
        off, inside, values = _measured(a, x)
        near = 2 * (np.linalg.norm(inside - np.diag(values)) + size * np.linalg.norm(off))
        gap = values - values[:, None]
        apart = np.abs(gap) > near
        step = np.where(apart, (inside + values * off) / np.where(apart, gap, 1.0), off / 2)
        x = x + x @ step
        clusters = _clusters(values, near)
        if clusters:
            off, inside, values = _measured(a, x)
        for at in clusters:
            own = np.ix_(at, at)
            mean = values[at].mean()
            rest = inside[own] - mean * (np.eye(len(at)) - off[own])
            x[:, at] = x[:, at] @ np.linalg.eigh((rest + rest.T) / 2)[1]
        found = sorted(len(c) for c in clusters)
        if np.abs(step).max() <= DONE and found == known:
            break
        known = found
    values = _measured(a, x)[2]
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]
