"""Small dense algebra on second moments. Sizes are set by the instrument, never by the rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Gram:
    """Sums of products over rows of ``(1, y, x)``, taken about a shift."""

    matrix: np.ndarray
    shift_y: float
    shift_x: np.ndarray

    @property
    def n(self) -> float:
        return float(np.rint(self.matrix[0, 0]))

    def means(self) -> tuple[float, np.ndarray]:
        """Means of y and x, about the shift."""
        return self.matrix[0, 1] / self.n, self.matrix[0, 2:] / self.n

    def about(self, mean_y: float, mean_x: np.ndarray) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Σ(y-c), Σ(y-c)², Σ(x-c)(y-c), Σ(x-c)(x-c)ᵀ about a centre given relative to the shift."""
        centre = np.concatenate([[mean_y], mean_x])
        total, second = self.matrix[0, 1:], self.matrix[1:, 1:]
        crossed = np.outer(total, centre)
        moved = second - crossed - crossed.T + self.n * np.outer(centre, centre)
        return total[0] - self.n * mean_y, moved[0, 0], moved[0, 1:], moved[1:, 1:]


@dataclass
class Training:
    """Standardised training moments (population deviation; a constant feature divides by 1)."""

    n: float
    mean_y: float
    mean_x: np.ndarray
    scale: np.ndarray
    yy: float
    xy: np.ndarray
    xx: np.ndarray


def standardise(gram: Gram) -> Training:
    mean_y, mean_x = gram.means()
    _, yy, xy, xx = gram.about(mean_y, mean_x)
    variance = np.clip(np.diag(xx), 0, None) / gram.n
    # a constant feature has no variance about a pilot row, or a speck of rounding about another shift
    floor = 1e-14 * np.diag(gram.matrix)[2:] / gram.n
    scale = np.where(variance > floor, np.sqrt(variance), 1.0)
    return Training(gram.n, mean_y, mean_x, scale, yy, xy / scale, xx / np.outer(scale, scale))


def f_scores(train: Training) -> np.ndarray:
    """Univariate regression F = r²/(1-r²)·(n-2); -inf for constant features."""
    norms = np.diag(train.xx) * train.yy
    with np.errstate(divide="ignore", invalid="ignore"):
        r2 = np.where(norms > 0, train.xy**2 / norms, np.nan)
        scores = r2 / (1 - r2) * (train.n - 2)
    return np.where(np.isnan(scores), -np.inf, scores)


def principal(xx: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and their vectors; each vector's largest loading is positive."""
    values, vectors = np.linalg.eigh(xx)
    values, vectors = values[::-1][:count].clip(min=0), vectors[:, ::-1][:, :count]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)


def soft(value: np.ndarray, bound: float) -> np.ndarray:
    return np.sign(value) * np.maximum(np.abs(value) - bound, 0.0)


def ridge_diagonal(values: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    """Ridge on uncorrelated features with sums of squares ``values``."""
    return xy / (values + alpha)


def elastic_diagonal(values: np.ndarray, xy: np.ndarray, n: float, alpha: float, l1: float) -> np.ndarray:
    """Elastic net on uncorrelated features: one soft threshold per feature."""
    return soft(xy / n, alpha * l1) / np.maximum(values / n + alpha * (1 - l1), 1e-300)


def elastic_dense(xx: np.ndarray, xy: np.ndarray, n: float, alpha: float, l1: float, sweeps: int = 20) -> np.ndarray:
    """Elastic net on the Gram matrix.

    A few sweeps of coordinate descent guess which weights are not zero; an active-set search then
    finishes exactly. Descent alone takes thousands of sweeps on neighbouring spectral points.
    """
    bound = alpha * l1
    quadratic = xx / n + alpha * (1 - l1) * np.eye(len(xy))
    linear, diagonal = xy / n, np.diag(quadratic)
    w, pull = np.zeros(len(xy)), xy / n  # pull = linear - quadratic @ w
    for _ in range(sweeps):
        before = w.copy()
        for j in np.flatnonzero(diagonal > 0):
            old, free = w[j], pull[j] + diagonal[j] * w[j]
            w[j] = np.sign(free) * max(abs(free) - bound, 0.0) / diagonal[j]
            if w[j] != old:
                pull = pull - quadratic[:, j] * (w[j] - old)
        if np.abs(w - before).max(initial=0.0) <= 1e-9:
            break
    return _finish(quadratic, linear, bound, w)


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Solution of a symmetric system, the shortest one if it is singular."""
    try:
        return np.linalg.solve(matrix, right)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(matrix, right, rcond=1e-13)[0]


def _finish(quadratic: np.ndarray, linear: np.ndarray, bound: float, w: np.ndarray) -> np.ndarray:
    """Feature-sign search from ``w``: solve for the weights not zero with their signs held, stop
    where a sign would change, let in the zero weight whose slope is steepest."""
    signs = np.sign(w)
    slack = 1e-9 * max(np.abs(linear).max(initial=0.0), 1e-300)
    for _ in range(20 * len(w) + 20):
        on = np.flatnonzero(signs)
        inner = quadratic[np.ix_(on, on)]
        aim = _solve(inner, linear[on] - bound * signs[on])
        if (np.sign(aim) == signs[on]).all():
            w[on] = aim
            slope = quadratic @ w - linear
            steep = np.where(signs == 0, np.abs(slope), 0.0)
            j = int(steep.argmax()) if len(w) else 0
            if len(w) == 0 or steep[j] <= bound + slack:
                return w
            signs[j] = -np.sign(slope[j])
            continue
        # best point on the way to the aim among those where a weight reaches zero
        start, way = w[on], aim - w[on]
        with np.errstate(divide="ignore", invalid="ignore"):
            stops = np.where(way != 0, -start / way, np.inf)
        steps = np.append(np.unique(stops[(stops > 0) & (stops < 1)]), 1.0)
        curve, tilt = way @ inner @ way, way @ (inner @ start - linear[on])
        sizes = np.abs(start[:, None] + way[:, None] * steps).sum(axis=0)
        step = steps[(curve * steps**2 / 2 + tilt * steps + bound * sizes).argmin()]
        moved = np.where(np.isclose(stops, step, rtol=1e-12, atol=0.0), 0.0, start + way * step)
        w[on], signs[on] = moved, np.sign(moved)
    return w


def pls_weights(xx: np.ndarray, xy: np.ndarray, n: float, components: int) -> np.ndarray:
    """Single-response PLS coefficients from XᵀX and Xᵀy, features brought to unit variance first.

    The covariance is deflated, never the data. Stops when no covariance is left.
    """
    spread = np.sqrt(np.diag(xx) / max(n - 1, 1))
    spread = np.where(spread > 0, spread, 1.0)
    gram, rest = xx / np.outer(spread, spread), xy / spread
    start = np.linalg.norm(rest)
    rotations, loadings, coefficients = [], [], np.zeros(len(xy))
    for _ in range(components):
        size = np.linalg.norm(rest)
        if size <= 1e-10 * start or size == 0:
            break
        rotation = rest / size
        for done, loading in zip(rotations, loadings):
            rotation = rotation - (loading @ (rest / size)) * done
        score = gram @ rotation
        energy = rotation @ score
        if energy <= 0:
            break
        loading, inner = score / energy, (rotation @ rest) / energy
        rest = rest - loading * inner * energy
        rotations.append(rotation)
        loadings.append(loading)
        coefficients += rotation * inner
    return coefficients / spread
