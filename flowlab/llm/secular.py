"""Eigenpairs of a symmetric matrix after a rank-one change, by its secular equation.

With A = U diag(d) U' and z = U'v, the eigenvalues of A + w vv' are the roots of
1 + w * sum(z_i^2 / (d_i - x)), one between each two neighbours of d and one above them. Parts
of z that are too small to matter, and equal values of d (after a rotation that moves their
weight to one of them), keep their eigenpairs: they are deflated. All roots are found at once,
each as its distance from the nearer pole; the weights z are then computed anew from the roots,
which keeps the new eigenvectors orthogonal to working precision."""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
#: Rounds of the root search; each has a bracket, so a slow root only loses digits, never its place.
ROUNDS = 80


def _roots(d: np.ndarray, z2: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """The roots for ascending, distinct ``d`` and squared unit weights: the index of each root's
    nearer pole and its distance from it."""
    k = len(d)
    at = np.arange(k)
    if k == 1:
        return at, np.array([weight * z2[0]])
    gap = np.append(d[1:] - d[:-1], weight)
    w2 = weight * z2
    middle = 1 + (w2[:, None] / ((d[:, None] - d) - gap / 2)).sum(axis=0)
    pole = np.where((middle < 0) & (at < k - 1), at + 1, at)
    half = gap / 2
    low = np.where(pole > at, -half, np.where((at == k - 1) & (middle < 0), half, 0.0))
    high = np.where(pole > at, 0.0, np.where((at == k - 1) & (middle < 0), gap, half))
    shift = d[:, None] - d[pole]
    x = (low + high) / 2
    left = np.minimum(at, k - 2)                                 # the two poles that the search bends around
    below = at[:, None] <= left                                  # the last root has both of its poles below it
    open_ = np.ones(k, bool)
    for _ in range(ROUNDS):
        j = np.flatnonzero(open_)
        away = shift[:, j] - x[j]
        term = w2[:, None] / away
        slope = term / away
        f = 1 + term.sum(axis=0)
        size = 1 + np.abs(term).sum(axis=0)
        low[j], high[j] = np.where(f < 0, x[j], low[j]), np.where(f < 0, high[j], x[j])
        done = (np.abs(f) <= 2 * EPS * size) | (high[j] - low[j] <= 2 * EPS * np.abs(x[j]))
        open_[j[done]] = False
        if not open_.any():
            break
        a1, a2 = away[left[j], np.arange(len(j))], away[left[j] + 1, np.arange(len(j))]
        all_slope = slope.sum(axis=0)
        slope_below = (slope * below[:, j]).sum(axis=0)
        c = f - a1 * slope_below - a2 * (all_slope - slope_below)
        a = (a1 + a2) * f - a1 * a2 * all_slope
        b = a1 * a2 * f
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        last = j == k - 1
        with np.errstate(divide="ignore", invalid="ignore"):
            step = np.where(last, np.where(a >= 0, (a + root) / (2 * c), 2 * b / (a - root)),
                            np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root)))
            newton = -f / all_slope
        step = np.where(f * step < 0, step, newton)              # a step against the slope is no step
        to = x[j] + step
        inside = (to > low[j]) & (to < high[j])
        x[j] = np.where(done, x[j], np.where(inside, to, (low[j] + high[j]) / 2))
    return pole, x


def _rotate_equal(d, z, u, tolerance):
    """Of values too close to tell apart, all the weight goes to the upper one."""
    at = None
    for j in np.flatnonzero(z).tolist():
        if at is not None:
            r = float(np.hypot(z[at], z[j]))
            c, s = z[j] / r, -z[at] / r
            if abs((d[j] - d[at]) * c * s) <= tolerance:
                z[at], z[j] = 0.0, r
                u[:, at], u[:, j] = u[:, at] * c + u[:, j] * s, u[:, j] * c - u[:, at] * s
                d[at], d[j] = d[at] * c * c + d[j] * s * s, d[at] * s * s + d[j] * c * c
        at = j


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, weight: float) -> tuple[np.ndarray, np.ndarray]:
    """Ascending eigenvalues and the eigenvectors (columns) after ``weight * v v'`` (``weight`` >= 0)
    is added."""
    z = v @ vectors
    rho = weight * float(z @ z)
    if not rho > 0:
        return values, vectors
    z /= np.sqrt(z @ z)
    tolerance = 8 * EPS * max(abs(float(values[-1])), abs(float(values[0])), rho)
    z[rho * np.abs(z) <= tolerance] = 0.0
    live = np.flatnonzero(z)
    if not len(live):                                            # a change below rounding
        return values, vectors
    d, u = values, vectors
    if len(live) > 1:
        r2 = z[live[1:]] ** 2 + z[live[:-1]] ** 2
        if (np.abs((d[live[1:]] - d[live[:-1]]) * z[live[1:]] * z[live[:-1]]) <= tolerance * r2).any():
            d, u = d.copy(), u.copy()
            _rotate_equal(d, z, u, tolerance)
            live = np.flatnonzero(z)
            live = live[np.argsort(d[live], kind="stable")]
    dl, k = d[live], len(live)
    pole, x = _roots(dl, z[live] ** 2, rho)
    away = (dl[:, None] - dl[pole]) - x                          # d_i - root_j
    between = dl - dl[:, None]                                   # d_j - d_i
    if k > 1:
        lower = np.tri(k, k - 1, -1, bool)
        ratio = -away[:, :-1] / np.where(lower, between[:, :-1], between[:, 1:])
        z2 = -away[:, -1] * ratio.prod(axis=1)
    else:
        z2 = -away[:, -1]
    zl = np.copysign(np.sqrt(np.maximum(z2, 0)), z[live])
    q = zl[:, None] / away
    q /= np.sqrt((q * q).sum(axis=0))
    new_values, new_vectors = d.copy(), u.copy()
    new_values[live], new_vectors[:, live] = dl[pole] + x, u[:, live] @ q
    order = np.argsort(new_values, kind="stable")
    return new_values[order], new_vectors[:, order]


class Spectrum:
    """Number, mean and the eigenpairs of the scatter matrix of the vectors seen so far."""

    def __init__(self, dims: int, n: int = 0, mean=None, values=None, vectors=None):
        self.n, self.mean = n, np.zeros(dims) if mean is None else mean
        self.values, self.vectors = np.zeros(dims) if values is None else values, np.eye(dims) if vectors is None else vectors

    def add(self, x: np.ndarray) -> None:
        """One more vector: a rank-one change by its distance from the mean."""
        away = x - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        if self.n > 1:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, (self.n - 1) / self.n)

    def join(self, other: Spectrum) -> None:
        """The vectors of ``other`` too: one rank-one change for each of its eigenpairs and one
        for the distance of the means."""
        if not other.n:
            return
        n = self.n + other.n
        away = other.mean - self.mean
        for e, u in zip(other.values[::-1], other.vectors.T[::-1]):
            if e > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, u, float(e))
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * other.n / n)
        self.mean, self.n = self.mean + away * (other.n / n), n
