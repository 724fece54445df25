"""Dense solves of p unknowns (numpy, on the driver or inside a task)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def check_alpha(alpha: float) -> None:
    if not alpha >= 0:
        raise ValueError("alpha must not be negative")


def ridge_slopes(spread: np.ndarray, cross: np.ndarray, alpha: float) -> np.ndarray:
    """Solve (spread + αI)·β = cross; of many solutions (α = 0), the shortest."""
    check_alpha(alpha)
    system = spread + alpha * np.eye(len(spread))
    if alpha > 0:
        return np.linalg.solve(system, cross)
    variances, axes = np.linalg.eigh(system)
    seen = variances > 1e-12 * max(variances.max(initial=0.0), 0.0)
    return axes[:, seen] @ ((axes[:, seen].T @ cross) / variances[seen])


def ridge_path(spread: np.ndarray, cross: np.ndarray, alphas: Sequence[float]) -> list[np.ndarray]:
    """:func:`ridge_slopes` for each penalty.

    One penalty is one solve. For more, spread = A·diag(v)·Aᵀ once, and each penalty
    is A·(Aᵀcross / (v + α)). Not where some number is no number.
    """
    if len(alphas) == 1 or not np.isfinite(spread).all():
        return [ridge_slopes(spread, cross, alpha) for alpha in alphas]
    for alpha in alphas:
        check_alpha(alpha)
    variances, axes = np.linalg.eigh(spread)
    turned = axes.T @ cross
    found = []
    for alpha in alphas:
        if alpha > 0:
            found.append(axes @ (turned / (np.maximum(variances, 0.0) + alpha)))
        else:
            seen = variances > 1e-12 * max(variances.max(initial=0.0), 0.0)
            found.append(axes[:, seen] @ (turned[seen] / variances[seen]))
    return found


def centre(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and Σ(z−z̄)(z−z̄)ᵀ from Σzzᵀ over [1, z].

    Sums about zero cannot tell a spread below their own rounding from none, so
    such a column counts as constant; co-moments have no such bound.
    """
    n = matrix[0, 0]
    means = matrix[0, 1:] / n
    centred = matrix[1:, 1:] - n * np.outer(means, means)
    varies = np.diag(centred) > 1e-13 * np.diag(matrix)[1:]
    return means, np.where(np.outer(varies, varies), centred, 0.0)


def grouped_ridge(means: np.ndarray, centred: np.ndarray, alpha: float) -> np.ndarray:
    """θ (intercept first) of each group from its means and co-moments over [x, y].

    A single-row group has no spread: its slopes are 0 and its intercept y.
    """
    p = means.shape[1] - 1
    spread, cross = centred[:, :p, :p], centred[:, :p, p]
    if alpha > 0:
        slopes = np.linalg.solve(spread + alpha * np.eye(p), cross[:, :, None])[:, :, 0]
    else:
        slopes = np.array([ridge_slopes(s, c, alpha) for s, c in zip(spread, cross)])
    intercepts = means[:, p] - (means[:, :p] * slopes).sum(axis=1)
    return np.column_stack([intercepts, slopes])


def tiled(bi, bj, mi, v, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and the full matrix from the tiles bi ≥ bj of one group."""
    side = len(mi[0])
    blocks = -(-size // side)
    means = np.zeros((blocks, side))
    tiles = np.zeros((blocks, blocks, side, side))
    for i, j, m, rows in zip(bi, bj, mi, v):
        tile = np.asarray(rows).reshape(side, side)
        tiles[i, j], tiles[j, i] = tile, tile.T
        if i == j:
            means[i] = m
    full = tiles.swapaxes(1, 2).reshape(blocks * side, blocks * side)
    return means.ravel()[:size], full[:size, :size]


def principal_axes(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k leading axes (as columns) and variances of a covariance matrix.

    An axis has no sign of its own; its entry of largest size is made positive.
    """
    variances, axes = np.linalg.eigh(covariance)
    order = np.argsort(variances)[::-1][:k]
    variances, axes = np.maximum(variances[order], 0.0), axes[:, order]
    leading = axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])]
    return axes * np.where(leading < 0, -1.0, 1.0), variances
