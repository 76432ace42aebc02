"""Leading principal axes of a covariance matrix by orthogonal iteration (M5).

Spark reduces the points to the d x d covariance (``matrix.covariance_sums``: partial products per
task, only those are shuffled). What is left has the size of the columns alone. A block of ``b``
orthonormal vectors is multiplied by the covariance and made orthonormal again, and the small
``b x b`` problem inside the block turns it to the axes; the share of variance of an axis is its
eigenvalue over the trace, so axes beyond the wanted ones are never worked out. The start is fixed,
hence reruns agree.

An axis is taken when ``|C v - l v| <= TOLERANCE * (largest eigenvalue)`` (for very wide tables: d rounding
errors of it). The block doubles when the axes in it
do not reach the asked share of variance, or come no nearer in ``ROUNDS`` multiplications; a block of d
vectors is the whole problem, so the iteration ends.
"""

from __future__ import annotations

import numpy as np

#: Largest residual of a taken axis, as a share of the largest eigenvalue.
TOLERANCE = 1e-13
#: Multiplications before a block that has not come within the tolerance doubles.
ROUNDS = 500
#: Rise of the block's share of variance below which a block that holds too few axes doubles at once.
SETTLED = 1e-4
#: Vectors of the first block.
BLOCK = 4


def _start(d: int, b: int) -> np.ndarray:
    """``b`` fixed orthonormal vectors: cosines of rising frequency, so no axis is at right angles to all of them by design."""
    grid = (np.arange(d) + 0.5)[:, None] * (np.arange(b) + 0.37)[None, :] * np.pi / d
    return np.linalg.qr(np.cos(grid) + 0.01 * np.sin(3.7 * grid))[0]


def _turned(cov: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block turned to the axes inside it, largest eigenvalue first."""
    values, turn = np.linalg.eigh(block.T @ cov @ block)
    return values[::-1], block @ turn[:, ::-1]


def _enough(values: np.ndarray, total: float, target: float | int) -> int | None:
    """How many of the axes are wanted; None if these are too few to tell."""
    if isinstance(target, int):
        return target if target <= len(values) else None
    if total <= 0:
        return 1
    over = np.nonzero(np.cumsum(values) / total > target)[0]
    return int(over[0]) + 1 if len(over) else None


def principal_axes(cov: np.ndarray, target: float | int) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues, d x m axes)``: the fewest leading axes whose share of the variance exceeds ``target``, or
    ``target`` axes if it is an int; never more than there are columns.

    Each axis has its largest loading (first of equals) positive. A matrix of zeros has no direction: its axes are
    the start's. Axes of equal eigenvalues span the right space but are not unique in it.
    """
    d = len(cov)
    if d == 0:
        raise ValueError("principal axes need at least one column")
    if isinstance(target, int):
        target = min(max(target, 1), d)
    total = float(np.trace(cov))
    b = min(d, max(BLOCK, target + 2 if isinstance(target, int) else 0))
    block = _start(d, b)
    while True:
        seen = -1.0
        for _ in range(ROUNDS):
            values, axes = _turned(cov, block)
            m = _enough(values, total, target)
            if b == d:
                m = m or d
            if m is not None:
                residual = np.linalg.norm(cov @ axes[:, :m] - axes[:, :m] * values[:m], axis=0)
                if b == d or residual.max() <= max(TOLERANCE, d * np.finfo(float).eps) * max(values[0], 0.0):
                    axes = axes[:, :m]
                    top = axes[np.abs(axes).argmax(axis=0), np.arange(m)]
                    return np.maximum(values[:m], 0.0), axes * np.where(top < 0, -1.0, 1.0)
            share = values.sum()
            if m is None and share - seen <= SETTLED * total:
                break
            seen = share
            block = np.linalg.qr(cov @ axes)[0]
        # keep what the block has found and fill up with vectors of the start
        b = min(d, 2 * b)
        block = np.linalg.qr(np.hstack([axes, _start(d, b)]))[0][:, :b]
