"""A logistic curve from binned outcomes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def logistic(bins: Sequence[tuple[float, int, float]]) -> tuple[float, float]:
    """Slope (positive) and offset from ``(value, outcome 0 or 1, weight)``, by Newton's steps."""
    z = np.array([b[0] for b in bins], dtype=float)
    y = np.array([b[1] for b in bins], dtype=float)
    w = np.array([b[2] for b in bins], dtype=float)
    design = np.stack([z, np.ones_like(z)], axis=1)
    at = np.array([0.5, 0.0])
    prior = np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ at, -50, 50)))
        slope = design.T @ (w * (y - p)) - prior @ at
        curve = design.T @ (design * (w * p * (1 - p))[:, None]) + prior
        step = np.linalg.solve(curve, slope)
        at = at + step / max(1.0, float(np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 1e-3), float(at[1])
